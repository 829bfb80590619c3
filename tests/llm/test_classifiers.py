import random
import zlib

import numpy as np
import pytest

from rentloom.llm import common, language, quality, queries, toxicity


def crc(i, divisor):
    return zlib.crc32(str(i).encode()) % divisor


def auc(labels, scores):
    order = np.argsort(np.argsort(scores, kind="stable"))
    ones = np.array(labels) == 1
    return (order[ones].sum() + ones.sum() - ones.sum() * (ones.sum() + 1) / 2) / ones.sum() / (~ones).sum()


@pytest.fixture(scope="module")
def middle():
    return "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, label, divisor, left_out, least", [
    ("op6_quality", "quality", 4, 2, 0.95), ("op7_toxicity", "toxic", 5, 0, 0.95)])
def test_held_out_accuracy(spark, middle, name, label, divisor, left_out, least):
    rows = {r.doc_id: r for r in queries.QUERIES[name](spark, middle).collect()}
    docs = common.table(spark, middle, "documents").select("doc_id").collect()
    assert set(rows) == {r.doc_id for r in docs}
    assert all(r.held_out == (crc(i, divisor) == left_out) and 0 <= r.score <= 1 for i, r in rows.items())
    known = {r.doc_id: r[label] for r in common.table(spark, middle, "labels").collect()}
    held = [i for i in known if i in rows and rows[i].held_out]
    assert auc([known[i] for i in held], [rows[i].score for i in held]) >= least
    assert np.mean([known[i] == rows[i].predicted for i in held]) >= 0.95


def test_language_accuracy(spark, middle):
    rows = {r.doc_id: r for r in queries.QUERIES["op10_language"](spark, middle).collect()}
    known = {r.doc_id: r.lang for r in common.table(spark, middle, "documents").collect()}
    assert set(rows) == set(known)
    held = [i for i, r in rows.items() if r.held_out]
    assert all((crc(i, 4) == 2) == r.held_out and 0 <= r.score <= 1 for i, r in rows.items())
    assert np.mean([rows[i].lang_pred == known[i] for i in held]) >= 0.98


def made(spark, n=400):
    """Good and bad, clean and toxic texts, with nulls, repeats and clashing columns."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice(["ba", "ko", "ri", "tu", "me", "sal"]) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(15, 80))]
        bad, toxic = i % 3 == 0, i % 4 == 1
        if toxic:
            for _ in range(2 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(["grumbel", "zorkish", "zorkable"]))
        text = " ".join(w.upper() + "!!" if bad else w for w in words)
        docs.append((i, text, "s", 0.5, 1))
        labels.append((i, 0 if bad else 1, int(toxic)))
    docs += [(n, None, None, None, None), (n + 1, "", "s", 0.1, 0), (None, "x", "s", 0.1, 0), (0, docs[0][1], "s", 0.5, 1)]
    labels += [(n + 5, 1, 1), (None, 1, 0), (1, None, None), (n, 1, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, score double, label int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_small_fits_and_filters(spark):
    docs, labels = made(spark)
    good, harmless = quality.fit(docs, labels), toxicity.fit(docs, labels)
    for model, module, column, right in ((good, quality, "quality", 1), (harmless, toxicity, "toxic", 1)):
        found = {r.doc_id: r.score for r in module.score(docs, model).collect()}
        assert len(found) == 403
        known = [tuple(r) for r in labels.select("doc_id", column).collect() if r.doc_id is not None and r.doc_id < 400 and r[1] is not None]
        assert np.mean([(found[i] >= module.THRESHOLD) == (y == right) for i, y in known]) >= 0.97
    kept = toxicity.harmless(quality.good(docs, good), harmless)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert all(i is None or i >= 400 or (i % 3 != 0 and i % 4 != 1) for i in ids) and len(ids) > 180


def test_folded_spellings_are_caught(spark):
    docs, labels = made(spark)
    model = toxicity.fit(docs, labels)
    score = toxicity.scorer(model)
    plain = "bako ri tume " * 6
    clean, caught, folded, wide = score([plain, plain + "zorkable grumbel zorkish ", plain + "z0rk@ble gruмbеl zоrk1sh ", plain + "ｚｏｒｋable grum​bel zorkish "])
    assert clean < 0.5 < caught
    assert abs(folded - caught) < 0.05 and abs(wide - caught) < 0.05


def test_exceptions_cancel_hits():
    model = toxicity.Model({"zork": 3.0}, frozenset({"zorkland", "saint zorker"}))
    match = toxicity.matcher(model)
    assert match("zork zorkland zorker saint zorker end")[2] == 2
    assert match("")[:3] == (0, 0.0, 0) and match("a")[:3] == (1, 0.0, 0)
    assert toxicity.words("5tupid 555-1234 m0r0n 7 R2") == ["stupid", "555", "1234", "moron", "7", "r2"]


def test_missing_labels_have_a_defined_result(spark):
    docs, labels = made(spark, 40)
    none = labels.filter("false")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {1.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    bad = quality.fit(docs, labels.filter("quality = 0"))
    assert quality.good(docs, bad).count() == 0
    empty = docs.filter("false")
    assert quality.score(empty, quality.fit(empty, none)).collect() == []
    assert toxicity.score(empty, toxicity.fit(empty, labels)).collect() == []
    assert language.predict(empty, language.fit(empty)).collect() == []


def test_models_ignore_rows_left_out(spark):
    docs, labels = made(spark, 120)
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(common.remainder("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, turned)


def test_languages_beyond_one_table_of_masks(spark):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    kinds = {f"l{i:02}": rng.sample([a + b for a in letters for b in letters], 6) for i in range(70)}
    rows = []
    for i in range(700):
        lang = f"l{i % 70:02}"
        rows.append((i, " ".join("".join(rng.choice(kinds[lang]) for _ in range(3)) for _ in range(40)), lang, 0.5))
    rows += [(800, None, "l01", 0.1), (801, "12 34 !!", "l01", 0.1), (802, rows[3][1], None, 0.1), (None, rows[4][1], "l04", 0.1), (3, rows[3][1], "l03", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    model = language.fit(docs)
    assert model.masks.shape[0] == 2 and len(model.languages) == 70
    got = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert np.mean([got[i].lang_pred == rows[i][2] for i in range(700)]) > 0.98
    assert (got[800].lang_pred, got[801].lang_pred, got[801].score) == ("und", "und", 0.0)
    assert got[802].lang_pred == "l03" and got[None].lang_pred == "l04"


def test_grams_do_not_depend_on_the_batch():
    texts = ["A.", "", "De.", "é", "..", "Re. x", "The\n\nlong  one", "x" * 5000]
    hashes, owner, lettered = language.grams(texts)
    for i, t in enumerate(texts):
        alone, _, has = language.grams([t])
        assert alone.tolist() == hashes[owner == i].tolist() and has[0] == lettered[i]


def test_samples_stay_bounded_with_a_hot_language_and_a_hot_id(spark):
    rows = [(i, f"text {i}", "en" if i % 50 else "de") for i in range(3000)] + [(7, f"copy {i}", "en") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    ids = language._first_ids(docs.select("doc_id", "lang"), 100)
    got = [(r.lang, r.doc_id) for r in ids.collect()]
    first = {k: sorted((common_hash, i) for common_hash, i in v)[:100] for k, v in hashed(spark, rows).items()}
    assert sorted(got) == sorted((k, i) for k, v in first.items() for _, i in v)
    hot = spark.createDataFrame([(7, "en"), (50, "de"), (51, "en")], "doc_id long, lang string")
    texts = sorted((r.doc_id, r.lang) for r in common.one_text_each(docs, hot, ["doc_id", "lang"]).collect())
    assert texts == [(7, "en"), (50, "de"), (51, "en")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, quality int")
    sample = common.labelled_sample(docs, labels, "quality", 4, 2, 200)
    assert sample.count() == sample.select("doc_id").distinct().count() == 400


def hashed(spark, rows):
    """(hash as it orders ids, id) of each language's ids."""
    out = {}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").select("doc_id", "lang").distinct()
    for r in df.selectExpr("doc_id", "lang", "shiftrightunsigned(xxhash64(doc_id), 12) AS h").collect():
        out.setdefault(r.lang, []).append((r.h, r.doc_id))
    return out


def test_filters_hold_the_exact_grams(spark):
    """The masks against plain sets: every n-gram of a language's set is found, and what else
    is found is as rare as the chance that the model takes off."""
    rng = random.Random(4)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "ghijk"}
    rows = [(i, " ".join("".join(rng.choice(letters[lang]) for _ in range(5)) for _ in range(60)), lang)
            for i in range(90) for lang in [sorted(letters)[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    size = 1 << 16
    model = language.fit(docs, size=size)
    assert model.languages == ("aa", "bb", "cc")
    counts = {lang: {} for lang in letters}
    for i, text, lang in rows:
        if crc(i, 4) != 2:
            for g in language.grams([text])[0].tolist():
                counts[lang][g] = counts[lang].get(g, 0) + 1
    total = {lang: sum(c.values()) for lang, c in counts.items()}
    top = {}
    for lang, c in counts.items():
        for g, n in c.items():
            top[g] = max(top.get(g, 0), n / total[lang])
    sets = {lang: {g for g, n in c.items() if n >= language.TIMES and n / total[lang] >= language.SHARE * top[g] * (1 - 1e-9)}
            for lang, c in counts.items()}
    every = np.array(sorted(top), np.uint64)
    masks = model.masks[0]
    found = masks[language.slots(every, 0, size)]
    for probe in range(1, language.PROBES):
        found &= masks[language.slots(every, probe, size)]
    for j, lang in enumerate(model.languages):
        told = {int(g) for g, f in zip(every, found) if int(f) >> j & 1}
        assert sets[lang] <= told
        outside = len(every) - len(sets[lang])
        assert len(told - sets[lang]) <= 5 + 3 * model.chance[j] * outside


def test_matches_equal_a_plain_scan():
    """Every entry tried at every beginning of a word, without an automaton."""
    rng = random.Random(6)
    syllables = ["zo", "rk", "mo", "ro", "n", "sa", "int"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    for _ in range(200):
        weights = {word() + rng.choice(["", " "]): rng.choice([1.0, 2.0, 4.0]) for _ in range(8)}
        text = " ".join(word() for _ in range(30))
        match = toxicity.matcher(toxicity.Model(weights, frozenset()))
        hits = weight = 0
        for w in toxicity.words(text):
            of = [x for e, x in weights.items() if (w + " ").startswith(e)]
            if of:
                hits, weight = hits + 1, weight + max(of)
        assert match(text)[2] == hits and match(text)[1] == pytest.approx(weight)


def test_scores_equal_plain_sums_of_sizes(spark):
    """Sizes of all kilobytes of a text, each compressed by itself; formula written out."""
    import zstandard

    docs, labels = made(spark, 120)
    model = quality.fit(docs, labels)
    by = [zstandard.ZstdCompressor(
        level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
        write_checksum=False, write_dict_id=False) for d in (model.good, model.bad)]
    found = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    for r in docs.collect():
        raw = (r.text or "").encode()
        good, bad = (sum(len(c.compress(raw[i: i + 1024])) for i in range(0, len(raw), 1024)) for c in by)
        x = (10 * (bad - good) / (bad + good), 20 * max(0, 0.25 - good / len(raw)), np.log(1 + len(raw)) / 4) if raw else (0, 0, 0)
        z = sum(w * v for w, v in zip(model.weights, (*x, 1)))
        assert found[r.doc_id] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)
