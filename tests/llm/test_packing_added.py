"""Strings of added tokens inside a text, as the tokenizer's library takes them by default."""

import random
from collections import defaultdict

import numpy as np

from wardlake.llm import packing


def test_added_tokens_are_the_librarys(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    rng = random.Random(15)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "it's", "é", "中", " ", "\t", "\n", "a", "1", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["<|endoftext|>", "a <|endoftext|> b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = defaultdict(list)
    for r in packing.pack(df, size=64).collect():
        found[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    for k, t in enumerate(texts):
        want = tok.encode(t, add_special_tokens=False).ids + [packing.END_ID]
        assert [x for _, ids, _ in sorted(found[k]) for x in ids] == want and found[k][0][2] == len(want), t
    assert 49407 in tok.encode(texts[-1], add_special_tokens=False).ids


def test_raw_ids_are_the_librarys_when_tables_start_anew():
    """Texts of known and new words, with tables so small that they start anew within and between calls."""
    from tokenizers import Tokenizer
    path = packing.vocabulary_path()
    tok, mine = Tokenizer.from_file(path), packing.WordTokenizer(path, entries=24)
    rng = random.Random(3)
    for n in (1, 3, 5, 40):
        texts = [" ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 6))) for _ in range(n)] + ["", " ", "a\nb  a"]
        for t, raw in zip(texts, mine.encode_raw(texts)):
            assert np.frombuffer(raw, mine.kind).tolist() == tok.encode(t, add_special_tokens=False).ids, t
