"""The rows of every stage of the pipeline against plain Python."""

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from test_operators import exact_j

from wardlake.llm import packing
from wardlake.llm.common import stage, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, _salt long, label string"


def prose(rng, n, lang):
    """Two words of five are of the 64 common ones of the language, so that no document's own words are among them."""
    common = [("" if lang == "en" else "z") + a + b for a in "abcdefgh" for b in "stuvwxyz"]
    made = [rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    return ". ".join(" ".join(made[k:k + 12]).capitalize() for k in range(0, n, 12)) + "."


def documents():
    rng = random.Random(16)
    texts = [prose(rng, rng.randint(90, 200), "en") for _ in range(60)]
    rows = [(k, t, "en", rng.choice(["a", "a", "b", None]), len(t), None, k, "x") for k, t in enumerate(texts)]
    for k in range(12):  # equal texts under other ids and in other sources, near copies
        rows.append((100 + k, texts[k], "en", "b", None, "k", 1, None))
        rows.append((200 + k, texts[20 + k].replace(".", "", 1) + " the", "en", "a", 7, None, None, "near"))
    rows += [rows[3], rows[3], rows[40]]  # rows that repeat
    rows += [(None, texts[50], "en", "a", 1, None, 1, None), (None, prose(rng, 120, "en"), "en", None, 1, None, 1, None)]
    junk = [None, "", "  ", "one two", "the of and " * 40, " ".join(str(rng.randint(1, 99_999)) for _ in range(150)), prose(rng, 300, "de")]
    return rows + [(300 + k, t, "en", "a", None, None, None, "junk") for k, t in enumerate(junk)]


def least(rows):
    return min(rows, key=lambda r: (r[0] is None, r[0] or 0))


def check_mix(before, after):
    size = {r: len(re.findall(r"[^\x20\x09-\x0d]+", r[1])) for r in before}
    copies, total, taken = Counter(after), Counter(), Counter()
    assert set(copies) <= set(before) and max(copies.values()) <= 3
    for r in before:
        total[r[3]] += size[r]
        taken[r[3]] += size[r] * copies[r]
    names = sorted(s for s in total if s is not None) + [None]
    weight, stuck = {s: k % 3 + 1 for k, s in enumerate(names)}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in stuck)
        free = sum(weight[s] for s in names if s not in stuck)
        target = {s: 3 * total[s] if s in stuck else left * weight[s] / free for s in names}
        over = {s for s in names if s not in stuck and target[s] > 3 * total[s]}
        if not over:
            break
        stuck |= over
    for s in names:
        assert abs(taken[s] - target[s]) <= max(size.values()), s


def check_packed(before, pieces):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    stream = sorted((r.sequence_id, r.offset, r.start, r.length, r.doc_id, r.doc_tokens, r.ids) for r in pieces)
    whole, at = [], 0
    for sequence, offset, start, length, doc, n, ids in stream:
        assert sequence * packing.SIZE + offset == at
        at += length
        if start == 0:
            whole.append([doc, n, []])
        whole[-1][2] += np.frombuffer(ids, "<u4").tolist()
        assert whole[-1][0] == doc and len(whole[-1][2]) == start + length <= n
    want = Counter((r[0], tuple(tok.encode(r[1], add_special_tokens=False).ids) + (packing.END_ID,)) for r in before)
    assert Counter((doc, tuple(ids)) for doc, _, ids in whole) == want


def test_every_stage(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    docs, out = table(spark, str(tmp_path), "documents"), []
    for name, f in corpus_pipeline.STAGES:
        docs = stage(f(spark, docs, str(tmp_path)), f"test-{name.replace(' ', '-')}")
        out.append(docs.collect())
        if name != "packing":
            assert docs.columns == [x.split()[0] for x in SCHEMA.split(", ")]
    good, distinct, unlike, mixed = [[tuple(r) for r in x] for x in out[:-1]]
    assert Counter(good) == Counter(r for r in rows if r[7] != "junk")
    same = defaultdict(list)
    for r in good:
        same[r[1]].append(r)
    largest = [max(x, key=lambda r: -1 if r[0] is None else r[0]) for x in same.values()]
    assert Counter(distinct) == Counter(largest)
    up = {r: r for r in distinct}

    def top(r):
        while up[r] != r:
            r = up[r]
        return r

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if top(a) != top(b) and exact_j(a[1], b[1]) >= 0.8:
                up[top(a)] = top(b)
    classes = defaultdict(list)
    for r in distinct:
        classes[top(r)].append(r)
    assert len(classes) < len(distinct)
    assert Counter(unlike) == Counter(map(least, classes.values()))
    check_mix(unlike, mixed)
    check_packed(mixed, out[-1])
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.start == 0) for r in run if r.start == 0) == Counter((r.doc_id, True) for r in out[-1] if r.start == 0)
    check_packed(mixed, run)
