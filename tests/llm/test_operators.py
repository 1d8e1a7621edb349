"""Every operator on a small table with nulls, empty and long texts, repeated rows and clashing columns, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlake.llm import (
    chat, exact_dedup, html_text, mixing, near_dedup, packing, pii, quality, token_counts, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, _salt long, label string"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.4 else
                    "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = words(rng, 200)
    texts = [None, "", "", "  ", "one two", base, base, base + " more", "x" + base, words(rng, 20_000), "a\nb\na"]
    texts += [words(rng, rng.randint(60, 150)) for _ in range(20)]
    out = [(k, t, [None, "en", "de"][k % 3], [None, "", "s1", "s2"][k % 4], None, "x", 1, None) for k, t in enumerate(texts)]
    return out + [out[5], (None, base, "en", "s1", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_hex, lambda t: F.substring(F.sha2(t, 256), 1, 1)])
def test_exact_dedup(docs, rows, empty, digest):
    """A one-digit digest puts different texts under one digest; the result is the same."""
    got = exact_dedup.decisions(docs, digest=digest).collect()
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    assert len(got) == len(rows)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_text[r.text_sha256]
        assert (r.keep_id, r.group_size) == (max(i for i in ids if i is not None), len(ids))
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(list(by_text))
    assert exact_dedup.decisions(empty).count() == 0
    left = exact_dedup.distinct_documents(docs)
    assert left.columns == docs.columns and left.count() == len(groups)


def exact_j(a, b):
    def weighted(t):
        ws = t.lower().split()
        n = min(5, len(ws))
        return Counter(tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)) if ws else Counter()
    x, y = weighted(a), weighted(b)
    every = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in every) for i in set(x) & set(y))


def test_near_dedup_against_brute_force(spark, docs, rows, empty):
    rng = random.Random(4)
    more = []
    for k in range(6):
        body = words(rng, 90).split()
        for edits in (0, 1, 2, 6, 25):
            copy = list(body)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = "edited"
            more.append((1000 + len(more), " ".join(copy), "en", "s", None, None, None, None))
    small = [r for r in rows if r[0] != 9] + more
    texts = sorted({r[1] or "" for r in small})
    up = {t: t for t in texts}

    def top(t):
        while up[t] != t:
            t = up[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if a.split() and b.split() and exact_j(a, b) >= 0.8:
                up[top(a)] = top(b)
    want = defaultdict(list)
    for r in small:
        want[top(r[1] or "")].append(r[0])
    digest = {hashlib.sha256(t.encode()).hexdigest(): top(t) for t in texts}
    got = near_dedup.classes(spark.createDataFrame(small, SCHEMA)).collect()
    assert len(got) == len(small)
    for r in got:
        ids = want[digest[r.text_sha256]]
        assert (r.class_id, r.class_size) == (min(i for i in ids if i is not None), len(ids))
    assert sum(r.kept for r in got) == len(want)
    assert near_dedup.classes(empty).count() == 0


def test_near_dedup_of_long_texts_repeats_and_other_columns(spark):
    """Texts of 20 000 words: an edited copy of J over 0.8 is linked, one below is not."""
    rng = random.Random(12)
    body = words(rng, 20_000).split()

    def edited(n):
        copy = list(body)
        for k in rng.sample(range(len(copy)), n):
            copy[k] = f"edited{k}"
        return " ".join(copy)

    long, near, far = " ".join(body), edited(250), edited(1500)
    j = [near_dedup.probability_jaccard(near_dedup.shingles(long), near_dedup.shingles(t)) for t in (near, far)]
    assert j[0] > 0.85 and j[1] < 0.6
    rows = [(1, long), (2, near), (2, near), (3, far), (4, None), (5, ""), (None, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS node", "'x' AS label", "2 AS bands", "3 AS bucket", "4 AS class_id", "false AS kept", "'y' AS digest", "5 AS _head")
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in near_dedup.classes(df).collect())
    assert got == Counter([(1, 1, 4), (2, 1, 4), (2, 1, 4), (None, 1, 4), (3, 3, 1), (4, 4, 2), (5, 4, 2)])
    left = near_dedup.one_of_each_class(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_block_links_connect_what_all_pairs_connect():
    rng = random.Random(5)
    body = words(rng, 80).split()
    texts = []
    for _ in range(40):
        copy = list(body)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(80)] = words(rng, 1)
        texts.append(" ".join(copy))
    n = len(texts)
    found = near_dedup._block_links(list(range(n)), list(range(n)), [0] * n, texts, False, 0.8)
    pairs = {(i, j) for i in range(n) for j in range(i + 1, n) if exact_j(texts[i], texts[j]) >= 0.8}

    def parts(links):
        up = list(range(n))
        for a, b in links:
            while up[a] != a:
                a = up[a]
            while up[b] != b:
                b = up[b]
            up[a] = b
        out = []
        for x in range(n):
            while up[x] != x:
                x = up[x]
            out.append(x)
        return len(set(out))

    assert {(a, b) for a, b, _ in found} <= pairs and parts((a, b) for a, b, _ in found) == parts(pairs)


def test_signature_estimates_probability_jaccard():
    a = (np.arange(100, dtype=np.uint64), np.full(100, 2))
    b = (np.arange(20, 120, dtype=np.uint64), np.r_[np.full(50, 2), np.full(50, 6)])
    a, b = [(near_dedup._mixed(h), w) for h, w in (a, b)]
    order = [np.argsort(x[0]) for x in (a, b)]
    a, b = [(x[0][o], x[1][o]) for x, o in zip((a, b), order)]
    s = near_dedup.signatures([a, b], 4096)
    assert abs((s[0] == s[1]).mean() - near_dedup.probability_jaccard(a, b)) < 0.03


def test_html():
    page = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div><aside>side</aside>
<article><h1>Title &amp; more</h1><p>First  long paragraph of the text,\n with <b>bold</b>&nbsp;words in it.<br><p>Short.
<form><p>Sign up</p></form><div class="comments"><p>First!</p></div><div class="ad">Buy</div><p>Last one.</article>
<footer>&copy; x</footer></body></html>"""
    assert html_text.main_text(page) == "Title & more\nFirst long paragraph of the text, with bold words in it.\nShort.\nLast one."
    assert html_text.main_text("") == "" and html_text.main_text("plain text") == "plain text"
    assert html_text.main_text("<p>a</p><![weird[ x <p>b") != ""


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (2, None, "<p>x</p>"), (2, None, "<p>x</p>")], "page_id long, url string, html string")
    assert sorted(map(tuple, html_text.extract(df).collect())) == sorted([(1, "u", "", 0), (2, None, "x", 1), (2, None, "x", 1)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def test_pii_base_against_patterns():
    """The linear finders agree with the plain patterns on random strings."""
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")),
                "card": 14 <= len(d) <= 19 and pii.luhn(d), "phone": 10 <= len(d) <= 15}[kind]

    rng = random.Random(6)
    for _ in range(20_000):
        t = "".join(rng.choice("aB1.2@34-5 +(6)7.8901..@-é") for _ in range(rng.randint(0, 60)))
        want = sorted((m.start(), k, m.end()) for k, name in enumerate(pii.KINDS)
                      for m in re.finditer(plain[name], t) if good(name, m.group()))
        assert pii.base_spans(t) == want, t


def test_pii_adds_spans_that_the_base_merges(spark):
    card = "4111111111111111"
    clean = [(k, f"call +1 (437) 555-06{k % 90 + 10} or card {card} or a@b.com or 1.2.3.4 x") for k in range(60)]
    df = spark.createDataFrame(clean + [(100, f"so {card} {card} end"), (101, None), (102, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert got[100].base == [] and got[100].spans == "card:3:19,card:20:36"
    assert got[101].spans == got[102].spans == "" and got[101].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.find(df.limit(0)).count() == 0


def test_quality_counts(docs, rows, empty):
    got = quality.decisions(docs).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, t, *_ in rows:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        three = Counter(zip(w, w[1:], w[2:]))
        hit = {k + j for k in range(len(w) - 2) if three[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines, dup = set(), 0
        for line in (t or "").split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                dup += line in lines
                lines.add(line)
        want[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit),
             len(w) < 50 or 100 * len(hit) > 50 * len(w)] += 1
    assert Counter(tuple(r[:7]) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.decisions(empty).count() == 0 and quality.good_documents(docs).columns == docs.columns


def test_quality_drops_junk(spark):
    rng = random.Random(7)
    good = [(k, words(rng, 150).capitalize() + ".", "en") for k in range(40)]
    junk = [(100, words(rng, 150).upper().replace(" ", "!! "), "en"), (101, words(rng, 150).replace(" ", "### "), "en"),
            (102, words(rng, 150).replace(" ", " | "), "en")]
    kept = {r.doc_id for r in quality.decisions(spark.createDataFrame(good + junk, "doc_id long, text string, lang string")).collect() if r.kept}
    assert kept == set(range(40))


def test_chat_folds_and_reads_back(spark):
    log = [(1, 1, 1, "delta", "user", "hi ~0 <|x|>"), (1, 2, 5, "delta", "assistant", "old"), (1, 2, 6, "regenerate", None, None),
           (1, 2, 8, "delta", "assistant", "[/INST]"), (1, 2, 7, "delta", "assistant", "</s>"), (1, 1, 9, "edit", "user", "ho"),
           (None, 1, 1, "delta", None, None)]
    df = spark.createDataFrame(log, "conv_id long, message long, seq long, kind string, role string, text string")
    made = chat.chat_format(df)
    assert "</s>[" not in made.filter("conv_id = 1").first().formatted.replace("</s>\n", "")
    back = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(made).collect()}
    assert back == {1: [("user", "ho", False), ("assistant", "</s>[/INST]", True)], None: [("", "", False)]}
    assert chat.chat_format(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="unknown kind"):
        chat.messages(df.withColumn("kind", F.lit("x"))).collect()


def test_chat_of_repeated_rows_long_texts_and_other_columns(spark):
    long = "ab ~<[|] " * 60_000
    turns = [(1, 0, "user", long), (1, 1, "assistant", long + "!"), (1, 1, "assistant", long + "!"), (2, None, None, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS seq", "'x' AS kind", "2 AS message", "'y' AS log", "3 AS formatted", "4 AS head")
    back = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.chat_format(chat.as_events(df))).collect()}
    assert back == {1: [("user", long, False)] + [("assistant", long + "!", True)] * 2, 2: [("", "", False)]}


def test_token_counts_against_plain_dynamic_programming(docs, empty):
    pieces, fallback = token_counts.load_pieces(token_counts.vocabulary_path())
    tiny = token_counts.UnigramTrie(pieces, fallback, nodes=50, entries=20)
    big = token_counts.UnigramTrie(pieces, fallback)
    unknown = min(pieces.values()) - token_counts.UNKNOWN_PENALTY
    rng = random.Random(8)
    for _ in range(300):
        word = "▁" + "".join(rng.choice("theandingofé漢😀xq") for _ in range(rng.choice([0, 3, 9, 120])))
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            here = [(best[s][0] + pieces[word[s:end]], -best[s][1] - 1) for s in range(max(0, end - 16), end) if word[s:end] in pieces]
            if word[end - 1] not in pieces:
                here.append((best[-1][0] + unknown, -best[-1][1] - len(word[end - 1].encode())))
            top = max(here)
            best.append((top[0], -top[1]))
        assert big.insert(word) == tiny.insert(word) == best[-1][1]
    got = token_counts.token_counts(docs).collect()
    assert {r.doc_id: r.n_tokens for r in got}[0] == 0 and token_counts.token_counts(empty).count() == 0


def test_mixing(spark, docs, rows, empty):
    rng = random.Random(9)
    many = [(100 + k, words(rng, rng.randint(1, 60)), "en", rng.choice(["a", "a", "a", "b", "c", None]), None, None, None, None)
            for k in range(600)]
    df = spark.createDataFrame(rows + many, SCHEMA)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows + many) and sorted(map(str, got)) == sorted(map(str, mixing.mix(df).collect()))
    size = Counter()
    for r in rows + many:
        size[r[3]] += len(re.findall("[^\x20\x09-\x0d]+", r[1] or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    target, stuck = {}, set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in stuck)
        weight = {s: k % 3 + 1 for k, s in enumerate(names) if s not in stuck}
        target = {s: 3 * size[s] if s in stuck else left * weight[s] / sum(weight.values()) for s in names}
        over = {s for s in weight if target[s] > 3 * size[s]}
        if not over:
            break
        stuck |= over
    taken = Counter()
    by_id = {r[0]: r[3] for r in rows + many}
    for r in got:
        s = by_id[r.doc_id]
        assert 0 <= r.copies <= 3 and abs(r.target - target[s if r.doc_id is not None else "s1"]) < 1e-6
        taken[s] += r.size * r.copies
    for s in ("a", "b", "c"):
        assert abs(taken[s] - target[s]) <= 60
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns


def test_mixing_of_one_row_repeated(spark, monkeypatch):
    """Equal rows are dealt to groups like any others: none holds more than a few times GROUP of them."""
    largest = []
    level = mixing._level

    def seen(rows, *rest):
        largest.append(rows.groupBy("rank", "groups", "at").count().agg(F.max("count")).first()[0])
        return level(rows, *rest)

    monkeypatch.setattr(mixing, "_level", seen)
    docs = spark.createDataFrame([(None, "one two three", "a")] * 3000 + [(1, "one two", "b")] * 500,
                                 "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == 3500 and max(largest) < 3 * mixing.GROUP
    for source_size in {r.source_size for r in got}:
        mine = [r for r in got if r.source_size == source_size]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= mine[0].size
        assert max(r.copies for r in mine) <= mixing.LARGEST


def test_packing_round_trip(docs, rows, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    tok.encode_special_tokens = True
    cut = packing.pack(docs, size=64).collect()
    want = Counter((r[0], tuple(tok.encode(r[1] or "", add_special_tokens=False).ids) + (1,)) for r in rows)
    places, docs_of = defaultdict(list), defaultdict(list)
    for r in cut:
        assert 0 < r.length == len(r.ids) // 4 and r.offset + r.length <= 64
        places[r.sequence_id].append((r.offset, r.length))
        docs_of[r.doc_id].append(r)
    for k, spans in places.items():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == 64 or k == max(places)
    for i, parts in docs_of.items():
        ids = [x for r in sorted(parts, key=lambda r: (r.sequence_id, r.offset)) for x in np.frombuffer(r.ids, "<u4").tolist()]
        assert Counter(ids) == sum((Counter(t) for (d, t), n in want.items() for _ in range(n) if d == i), Counter())
    assert packing.pack(empty).count() == 0
    whole = packing.sequences(packing.pack(docs, size=64), size=64).collect()
    assert all(len(r.ids) == 256 for r in whole)


def test_word_tokenizer_is_exact():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary_path())
    tok.encode_special_tokens = True
    mine = packing.WordTokenizer(packing.vocabulary_path(), entries=200)
    rng = random.Random(10)
    texts = ["".join(rng.choice("ab'sStT.,!  \n\t\r\x1c\x85\xa0éÀßİıſσΣς́中😀1²½<|endoftext|></w>_-") for _ in range(rng.randint(0, 40)))
             for _ in range(2000)] + ["<|endoftext|>", "", " ", "IT'S we'll"]
    for k in range(0, len(texts), 50):
        for t, ids in zip(texts[k:k + 50], mine.encode(texts[k:k + 50])):
            assert tok.encode(t, add_special_tokens=False).ids == ids.tolist(), t


def test_toxicity_held_out(spark, empty):
    rng = random.Random(11)
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        text = words(rng, 40) + (" " + rng.choice(["idiot", "worthless", "grumbleox" + rng.choice("abc")]) if bad else "")
        docs.append((k, text))
        if k < 300:
            labels.append((k, int(bad)))
    docs.append((1000, None))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    chain = toxicity.train(d, spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id long, toxic int"))
    got = {r.doc_id: r.is_toxic for r in toxicity.score(d, chain).collect()}
    assert [got[k] for k in range(300, 400)] == [k % 4 == 0 for k in range(300, 400)] and got[1000] is False
    none = toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(empty, none).count() == 0 and toxicity.score(d, none).filter("is_toxic").count() == 0


def test_toxicity_of_repeated_rows_long_texts_and_other_columns(spark):
    rng = random.Random(5)
    rows = [(k, words(rng, 30) + (" idiot" if k % 3 == 0 else "")) for k in range(120)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(120)] * 2, "doc_id long, toxic int")
    long = words(rng, 50_000)
    more = [(200, long), (201, long + " idiot"), (201, long + " idiot"), (None, "idiot"), (202, "")]
    wide = spark.createDataFrame(rows + more, "doc_id long, text string").selectExpr(
        "*", "1 AS toxic", "'x' AS feature", "2 AS clean", "3 AS fold", "4 AS insult", "5 AS p_toxic", "true AS is_toxic")
    got = toxicity.score(wide, toxicity.train(wide, labels.withColumn("text", F.lit("z")))).collect()
    assert len(got) == 125 and all(r.is_toxic == (r.doc_id % 3 == 0) for r in got if r.doc_id is not None and r.doc_id < 120)
    assert len({tuple(r) for r in got if r.doc_id == 201}) == 1
    assert [r.is_toxic for r in got if r.doc_id == 202] == [False]
