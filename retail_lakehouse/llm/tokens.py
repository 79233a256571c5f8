"""Whole-text encoding with the public BPE vocabularies, inside Arrow tasks.

Both vocabularies split a text into pre-tokens that never span the start of a
white-space run, so a text's ids are the ids of its parts ("a word with the
white space before it") one after another. Corpora repeat words, so each
worker encodes a part once, remembers the ids and gathers them per document.
The memory is bounded: ``CACHE_PARTS`` parts, after which only those that were
used again are kept. Texts are encoded whole, whatever their length; the
working set is one slice of ``SLICE_BYTES`` plus one document's ids.
"""

from __future__ import annotations

import ctypes
import re
import string
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CACHE_PARTS = 400_000
SLICE_BYTES = 8_000_000

# The code points with Unicode's White_Space property.
_WS = "\t-\r \x85\xa0  -     　"
_PARTS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_TWO_SPACES = r"[\t-\r \x{85}\p{Z}]{2}"
_JOINED_BYTES = 200_000
_TAIL = ".,;:!?|"
_LATIN = "[A-Za-zªµºÀ-ÖØ-öø-ÿ]+"  # letters up to U+00FF


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()
_HIGH_LETTERS = {b: c for b, c in _LETTERS.items() if b > 127}


class PartEncoder:
    """Ids of texts by their parts. ``leading_space``: parts carry the white
    space before them (byte-level vocabulary); otherwise white space is dropped
    (word vocabulary)."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        probe = self.tok.encode("a a", add_special_tokens=False).ids
        self.leading_space = self.tok.encode("a", add_special_tokens=False).ids * 2 != probe
        vocab = self.tok.get_vocab()
        size = max(vocab.values()) + 1
        self.opens = np.zeros(size, dtype=bool)  # tokens that begin with a space
        for token, i in vocab.items():
            self.opens[i] = token.startswith("Ġ")
        self.separator = self.tok.encode("\x01", add_special_tokens=False).ids
        self.tails: dict[str, list[int]] = {"": []}
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[str, int] = {}
        self.begin = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int32)
        self.pool = np.zeros(0, dtype=np.uint32)

    def _forget(self) -> None:
        """Keep the parts used more than once; the rest will be encoded again if they return."""
        keep = [p for p, s in self.slot.items() if self.uses[s] > 1]
        if len(keep) > CACHE_PARTS // 2:
            keep = []
        old = np.fromiter((self.slot[p] for p in keep), dtype=np.int64, count=len(keep))
        pool, count = gather(self.pool, self.begin[old], self.count[old]), self.count[old]
        self._reset()
        self._add(keep, pool, count)

    def _add(self, parts: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        n = len(self.slot)
        self.slot.update(zip(parts, range(n, n + len(parts))))
        start = len(self.pool) + np.concatenate([[0], np.cumsum(count)[:-1]]) if len(parts) else np.zeros(0)
        self.begin = np.concatenate([self.begin, start.astype(np.int64)])
        self.count = np.concatenate([self.count, count.astype(np.int64)])
        self.uses = np.concatenate([self.uses, np.zeros(len(parts), dtype=np.int32)])
        self.pool = np.concatenate([self.pool, ids.astype(np.uint32)])

    def _singly(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tok.encode_batch(parts, add_special_tokens=False)]
        count = np.fromiter((len(x) for x in found), dtype=np.int64, count=len(found))
        return np.fromiter((i for x in found for i in x), dtype=np.uint32, count=int(count.sum())), count

    def _together(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode many parts as one text and cut its ids at the part starts."""
        glue = "" if self.leading_space else " \x01 "
        ids = np.array(self.tok.encode(glue.join(parts), add_special_tokens=False).ids, dtype=np.uint32)
        if self.leading_space:
            at = np.flatnonzero(self.opens[ids])
            if len(at) == len(parts) and at[0] == 0:
                return ids, np.diff(np.append(at, len(ids)))
        elif len(self.separator) == 1:
            mark = ids == self.separator[0]
            at = np.flatnonzero(mark)
            if len(at) == len(parts) - 1:
                return ids[~mark], np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
        return self._singly(parts)

    def _words(self, parts: list[str]) -> list[str]:
        """Learn the parts that are one run of Latin letters with or without
        closing punctuation, straight from the vocabulary's model (they are one
        or two pre-tokens, and normalizing leaves them as they are); returns the other parts."""
        rest, done, ids, count = [], [], [], []
        tokenize, tails = self.tok.model.tokenize, self.tails
        line = self.tok.encode("\n", add_special_tokens=False).ids
        for p in parts:
            head = p[:1] if p[:1] in (" ", "\n") else ""
            word = p[1:] if head else p
            core = word.rstrip(_TAIL)
            if not core.isalpha() or (not core.isascii() and max(core) > "\xff"):
                rest.append(p)
                continue
            tail = word[len(core):]
            if tail not in tails:
                if len(tails) > 10_000:
                    self.tails = tails = {"": []}
                tails[tail] = self.tok.encode(tail, add_special_tokens=False).ids
            shown = core if core.isascii() else core.encode().decode("latin-1").translate(_LETTERS)
            found = [t.id for t in tokenize("Ġ" + shown if head == " " else shown)]
            if tail:
                found += tails[tail]
            if head == "\n":
                found = line + found
            done.append(p)
            ids += found
            count.append(len(found))
        self._add(done, np.array(ids, dtype=np.uint32), np.array(count, dtype=np.int64))
        return rest

    def _cores(self, parts: list[str]) -> list[str]:
        """The same for the word vocabulary, whose parts of letters have no punctuation."""
        letters = pc.match_substring_regex(pa.array(parts, pa.string()), f"^{_LATIN}$").to_numpy(zero_copy_only=False).tolist()
        done, rest = [p for p, k in zip(parts, letters) if k], [p for p, k in zip(parts, letters) if not k]
        ids, count, tokenize = [], [], self.tok.model.tokenize
        shown = "\n".join(done).lower().encode().decode("latin-1").translate(_HIGH_LETTERS)
        for word in shown.split("\n") if done else ():
            found = tokenize(word)
            ids += [t.id for t in found]
            count.append(len(found))
        self._add(done, np.array(ids, dtype=np.uint32), np.array(count, dtype=np.int64))
        return rest

    def _learn(self, parts: list[str]) -> None:
        plain, odd = [], []
        for p in (self._words if self.leading_space else self._cores)(parts):
            if self.leading_space:
                ok = len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace()
            else:
                ok = "\x01" not in p
            (plain if ok else odd).append(p)
        for lot, encode in ((plain, self._together), (odd, self._singly)):
            at = 0
            while at < len(lot):
                end, size = at, 0
                while end < len(lot) and size < _JOINED_BYTES:
                    size += len(lot[end]) + 4
                    end += 1
                ids, count = encode(lot[at:end])
                self._add(lot[at:end], ids, count)
                at = end

    def _slots(self, parts: list[str]) -> np.ndarray:
        """Cache slots of distinct parts, encoding those not yet known."""
        get = self.slot.get
        new = [p for p in parts if get(p) is None]
        if new:
            self._learn(new)
        get = self.slot.__getitem__
        return np.fromiter(map(get, parts), dtype=np.int64, count=len(parts))

    def _spaced_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Slots of all parts in order, and how many each text has."""
        two = pc.match_substring_regex(texts, _TWO_SPACES).to_numpy(zero_copy_only=False)
        n = len(texts)
        out: list = [None] * n
        easy = np.flatnonzero(~two)
        if len(easy):
            # A line break is followed by a word here: its part is "\n" + word.
            split = pc.split_pattern(pc.replace_substring(texts.take(pa.array(easy)), "\n", " \n"), " ")
            pieces, ends = split.flatten(), split.offsets.to_numpy()
            coded = pieces.dictionary_encode()
            words = [w if w[:1] == "\n" else " " + w for w in strings(coded.dictionary)]
            codes = coded.indices.to_numpy()
            firsts = strings(pieces.take(pa.array(ends[:-1])))
            # The first piece of a text has no space before it; '' then has no ids at all.
            distinct = list(dict.fromkeys(firsts))
            used = np.ones(len(codes), dtype=bool)
            used[ends[:-1]] = False
            needed = np.zeros(len(words), dtype=bool)
            needed[codes[used]] = True
            want = [w for w, u in zip(words, needed.tolist()) if u]
            slots = np.zeros(len(words), dtype=np.int64)
            slots[needed] = self._slots(want)
            first_slot = dict(zip(distinct, self._slots(distinct).tolist()))
            flat = slots[codes]
            flat[ends[:-1]] = [first_slot[f] for f in firsts]
            for k, i in enumerate(easy.tolist()):
                out[i] = flat[ends[k]:ends[k + 1]]
        hard = np.flatnonzero(two)
        for i in hard.tolist():
            parts = _PARTS.findall(texts[i].as_py())
            known = list(dict.fromkeys(parts))
            where = dict(zip(known, self._slots(known).tolist()))
            out[i] = np.fromiter((where[p] for p in parts), dtype=np.int64, count=len(parts))
        return np.concatenate(out) if n else np.zeros(0, np.int64), np.array([len(x) for x in out], dtype=np.int64)

    def _word_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for the word vocabulary. A run of Latin letters and its closing
        punctuation are parts of their own, in lower case as the vocabulary reads
        them: corpora repeat them more than they repeat the whole word."""
        split = pc.ascii_split_whitespace(texts)
        coded, ends = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        words = coded.dictionary
        bare = pc.utf8_rtrim(words, string.punctuation)
        letters = pc.match_substring_regex(bare, f"^{_LATIN}$")
        cores = pc.if_else(letters, pc.utf8_lower(bare), words).dictionary_encode()
        closed = pc.and_(letters, pc.less(pc.binary_length(bare), pc.binary_length(words))).to_numpy(zero_copy_only=False)
        tails = pc.replace_substring_regex(words.filter(pa.array(closed)), f"^{_LATIN}", "").dictionary_encode()
        core, tail = (self._slots(strings(d.dictionary))[d.indices.to_numpy()] for d in (cores, tails))
        n = 1 + closed.astype(np.int64)
        begin = np.cumsum(n) - n
        slots = np.empty(int(n.sum()), dtype=np.int64)
        slots[begin], slots[begin[closed] + 1] = core, tail
        codes = coded.indices.to_numpy()
        pieces = n[codes]
        per_text = np.concatenate([[0], np.cumsum(pieces)])[ends - ends[0]]
        return gather(slots, begin[codes], pieces), np.diff(per_text).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids per text) for one slice; nulls are empty."""
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        if len(self.slot) > CACHE_PARTS:
            self._forget()
        slots, parts = (self._spaced_parts if self.leading_space else self._word_parts)(texts)
        # Saturate at 2: a count is only asked whether the part came back.
        seen = np.zeros(len(self.uses), dtype=bool)
        seen[slots] = True
        self.uses = np.minimum(self.uses + seen, 2)
        ids = gather(self.pool, self.begin[slots], self.count[slots])
        per_part = np.concatenate([[0], np.cumsum(self.count[slots])])
        ends = np.concatenate([[0], np.cumsum(parts)])
        return ids, per_part[ends[1:]] - per_part[ends[:-1]]


def strings(a: pa.Array) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()


def gather(pool: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """pool[b:b+c] for each (b, c), one after another."""
    total = int(count.sum())
    if not total:
        return pool[:0]
    shift = begin - np.concatenate([[0], np.cumsum(count)[:-1]])
    return pool[np.repeat(shift, count) + np.arange(total)]


@lru_cache(maxsize=4)
def encoder(path: str) -> PartEncoder:
    """One encoder per worker process and vocabulary; it outlives the task."""
    return PartEncoder(path)


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and what
    its allocators hold back is missing elsewhere on the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES):
    """Consecutive pieces of ``batch`` whose ``column`` holds about ``max_bytes`` (one row at least)."""
    col = batch.column(batch.schema.get_field_index(column))
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, ends = 0, np.cumsum(size)
    while at < len(size):
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(at, end - at)
        at = end
        give_back()
