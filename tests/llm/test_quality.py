"""What the quality rules must reject and what they must not."""

import random

from wardlake.llm import quality

SCHEMA = "doc_id long, text string, lang string"
COMMON = {"en": ["the", "of", "and", "to"], "de": ["der", "die", "und", "zu"]}


def prose(rng, n, lang):
    made = [rng.choice(COMMON[lang]) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    return ". ".join(" ".join(made[k:k + 12]).capitalize() for k in range(0, n, 12)) + "."


def test_texts_without_the_language_are_dropped(spark):
    """Numbers, random letters in sentences, emoji and another language, each short and long; numbers in prose are no junk."""
    rng = random.Random(12)
    good = [(k, prose(rng, rng.randint(100, 300), lang), lang) for k, lang in enumerate(["en", "de"] * 40)]
    good += [(80, prose(rng, 200, "en") + " In 1990, 1200 of 3400, in 2001, 7000 of 8100.", "en")]
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = []
    for n in (60, 400):
        gibberish = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(n)]
        junk += [(" ".join(str(rng.randint(1, 99_999)) for _ in range(n)), "en"), (" ".join(gibberish), "de"),
                 (". ".join(" ".join(gibberish[k:k + 8]).capitalize() for k in range(0, n, 8)), "en"),
                 (" ".join("".join(rng.choice("😀😁🎉❤") for _ in range(5)) for _ in range(n)), "en")]
    junk += [(prose(rng, 400, "de"), "en"), (prose(rng, 400, "en"), "de")]
    rows = good + [(100 + k, t, lang) for k, (t, lang) in enumerate(junk)]
    kept = {r.doc_id for r in quality.decisions(spark.createDataFrame(rows, SCHEMA)).collect() if r.kept}
    assert kept == set(range(81))


def test_classes_beyond_latin():
    shares = dict(zip(quality.CLASSES, quality.char_classes("Привет, мир。😀 12345678901234567890" + "\U00020000\U000f0000").tolist()))
    assert shares["upper"] == 1 and shares["sign"] == 2 and shares["stop"] == 2 and shares["digit"] == 17


def test_rare_languages_keep_their_documents(spark):
    """Far under a thousandth of all words: too few for a reference (my), or one of their own (th, ru); long words, so few spaces."""
    rng = random.Random(13)
    base = prose(rng, 20_000, "en").split(". ")
    rows = [(k, ". ".join(base[k:] + base[:k]), "en") for k in range(250)]

    def foreign(lang, first, letters, docs, n):
        common = ["".join(rng.choice(letters) for _ in range(4)) for _ in range(4)]
        return [(first + k, " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(30))
                                     for _ in range(n)), lang) for k in range(docs)]

    rows += foreign("my", 1000, "ကခဂဃငစဆဇဈ", 3, 60) + foreign("th", 1100, "กขคงจฉชซฌ", 20, 120) + foreign("ru", 1200, "абвгдежзи", 20, 120)
    rows += [(1300, "12 345 6789 " + " ".join(str(rng.randint(1, 9999)) for _ in range(120)), "th")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert {r.doc_id for r in quality.decisions(df).collect() if not r.kept} == {1300}


def test_joined_references_judge_as_held_ones(spark, monkeypatch):
    rng = random.Random(14)
    rows = [(k, prose(rng, rng.randint(80, 200), lang), [lang, None][k % 5 == 4]) for k, lang in enumerate(["en", "de"] * 60)]
    rows += [(200, prose(rng, 300, "en"), "de"), (201, " ".join(map(str, range(90))), "fr"), (202, None, "zz"), (202, None, "zz"), (203, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    held = quality.decisions(df).collect()
    good = quality.good_documents(df).collect()
    for most in (1, 2):
        monkeypatch.setattr(quality, "MAX_HELD", most)
        assert sorted(map(str, quality.decisions(df).collect())) == sorted(map(str, held))
        assert sorted(map(str, quality.good_documents(df).collect())) == sorted(map(str, good))
    assert 200 not in {r.doc_id for r in good} and len(held) == len(rows)
