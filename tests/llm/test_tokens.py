import random

import numpy as np
import pyarrow as pa
import pytest

from retail_lakehouse.llm import queries, tokens

ODD = ["", None, " ", "  ", "a  b", "a   b \n c", "\n\nx y\n", " lead", "trail ", "x\x01 y \x01", "it's IT'S we'll",
       "a b 　 c d", "<|endoftext|> x <|endoftext|>", "é ́x İstanbul ΑΣ Σ",
       "１２３ 四五", "a\tb\rc\x0bd", "1234 5 67", " \n", "\x1c a\x1c b", "\U0001f600 \U0001f600\U0001f600", "a \n"]


@pytest.mark.parametrize("name", [queries.BYTE_BPE, queries.WORD_BPE])
def test_parts_give_the_ids_of_the_whole_text(name):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab '.,s\n\t 1é") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choice("abÀéßµªº .,!|İ") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    enc = tokens.PartEncoder(queries.tokenizer_path(name))
    for _ in range(2):  # the second time from what was remembered
        ids, counts = enc.encode(pa.array(texts))
        ends = np.concatenate([[0], np.cumsum(counts)])
        for i, t in enumerate(texts):
            assert enc.tok.encode(t or "", add_special_tokens=False).ids == ids[ends[i]:ends[i + 1]].tolist(), t


def test_forgetting_keeps_ids_right(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PARTS", 50)
    enc = tokens.PartEncoder(queries.tokenizer_path(queries.BYTE_BPE))
    for k in range(6):
        texts = [f"alpha beta{k} gamma{j} delta" for j in range(40)]
        ids, counts = enc.encode(pa.array(texts))
        ends = np.concatenate([[0], np.cumsum(counts)])
        for i, t in enumerate(texts):
            assert enc.tok.encode(t).ids == ids[ends[i]:ends[i + 1]].tolist()


def test_slices_cover_the_batch():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "", "c"]})
    parts = list(tokens.slices(batch, "text", 20))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()


def test_words_share_their_letters():
    enc = tokens.PartEncoder(queries.tokenizer_path(queries.WORD_BPE))
    texts = ["Été été, ÉTÉ!! (été) été's x2&&", "été&& b.c", "", "&& ,"]
    ids, counts = enc.encode(pa.array(texts))
    ends = np.concatenate([[0], np.cumsum(counts)])
    for i, t in enumerate(texts):
        assert enc.tok.encode(t, add_special_tokens=False).ids == ids[ends[i]:ends[i + 1]].tolist(), t
    # The letters are learned once, whatever their case and closing punctuation.
    assert set(enc.slot) == {"", "été", ",", "!!", "(été)", "été's", "x2&&", "&&", "b.c"}


def test_words_with_any_punctuation():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abZÀéßµ's''t&$%*_^`~<=>-.̸ ") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    enc = tokens.PartEncoder(queries.tokenizer_path(queries.WORD_BPE))
    ids, counts = enc.encode(pa.array(texts).slice(7))
    ends = np.concatenate([[0], np.cumsum(counts)])
    for i, t in enumerate(texts[7:]):
        assert enc.tok.encode(t, add_special_tokens=False).ids == ids[ends[i]:ends[i + 1]].tolist(), t
