import contextlib
import hashlib
import io
import random

from pyspark.sql import functions as F

from rentloom.llm import queries, winnow


def windows(hashes, w):
    """Positions that winnowing keeps, by its definition."""
    kept = set()
    for i in range(max(1, len(hashes) - w + 1)):
        part = hashes[i: i + w]
        if part:
            least = min(part)
            kept.add(i + max(j for j, h in enumerate(part) if h == least))
    return sorted(kept)


def prints(spark, texts, **more):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", winnow.fingerprint(F.col("t"), **more).alias("f")).collect()
    return [[(x.hash, x.position) for x in r.f] for r in sorted(rows)]


def test_minima_with_rightmost_ties(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (1, 3, 4, 5, 11, 12, 13, 40, 300)] + ["a " * 50]
    for text, found in zip(texts, prints(spark, texts)):
        words = text.split()
        # every rolled hash by itself: texts of K words have just one
        grams = [" ".join(words[i: i + winnow.K]) for i in range(max(1, len(words) - winnow.K + 1))]
        single = [p[0][0] for p in prints(spark, grams)]
        assert [p for _, p in found] == windows(single, winnow.W)
        assert all(single[p] == h for h, p in found)


def test_shared_runs_are_found(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    run = [word() for _ in range(winnow.K + winnow.W - 1)]
    a = [word() for _ in range(37)] + run + [word() for _ in range(11)]
    b = [word() for _ in range(5)] + run + [word() for _ in range(60)]
    fa, fb = prints(spark, [" ".join(a), " ".join(b)])
    shared = [(p, q) for h, p in fa for g, q in fb if h == g]
    assert any(a[p: p + winnow.K] == b[q: q + winnow.K] for p, q in shared)


def test_short_empty_and_unspaced_texts(spark):
    none, empty, blank, one, two, same, han = prints(spark, [None, "", " \n\t", "x", "x y", "  x\ny ", "漢字漢字仮名交"])
    assert none == empty == blank == []
    assert len(one) == 1 and one != two and two == same
    assert len(han) >= 1


def edited(rows):
    """(doc_id, edited text) by the definition."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for at, (i, t) in enumerate(order):
        following, t = order[(at + 1) % len(order)][1] or "", t or ""
        out[i] = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
    return out


def test_query_against_brute_force(spark, smallest, small):
    rows = [(r[0], r[1]) for r in small("documents")]
    texts, changed = dict(rows), edited(rows)
    got = {r.doc_id: r for r in queries.QUERIES["op2_fingerprints"](spark, smallest).collect()}
    assert len(got) == len(rows)
    ids = sorted(texts, reverse=True)
    for at, i in enumerate(ids):
        r = got[i]
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(changed[i].encode()).hexdigest()
        following = got[ids[(at + 1) % len(ids)]]
        for value, other in ((r.near_edited, r.edited_fingerprint), (r.near_next, following.fingerprint)):
            a, b = set(r.fingerprint.split()), set(other.split())
            assert abs(value - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
        assert r.near_edited == 1 or r.fingerprint != r.edited_fingerprint
        assert len(r.positions) == len(r.fingerprint.split()) and r.positions == sorted(set(r.positions))
        assert len(r.edited_positions) == len(r.edited_fingerprint.split())
    # equal places come from equal words: what an edited text shares with its own stands there too
    r = max(got.values(), key=lambda r: len(r.positions))
    kept = [(p, h) for p, h in zip(r.positions, r.fingerprint.split()) if p < max(r.positions) // 2]
    assert kept and set(kept) <= set(zip(r.edited_positions, r.edited_fingerprint.split()))
    by_text = {}
    for i, t in texts.items():
        by_text.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_gaps_nulls_repeats_and_one_document(spark):
    schema = "doc_id long, text string, own string, next_id string"
    rows = [(5, "abcdef", "x", "y"), (-3, None, "x", "y"), (10**12, "uvw xyz", "x", "y"), (5, "abcdef", "x", "y"), (None, "nobody", "x", "y")]
    got = winnow.compared(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5
    sha = {r.doc_id: r.edited_sha256 for r in got}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sha == {10**12: digest("uvw xab"), 5: digest("abcd"), -3: digest(""), None: digest("nobo")}
    for blocks in (1, 2, 40):
        again = winnow.compared(spark.createDataFrame(rows, schema), blocks=blocks).collect()
        assert {r.doc_id: r.edited_sha256 for r in again} == sha and len(again) == 5
    alone = winnow.compared(spark.createDataFrame(rows[:1], schema)).first()
    assert alone.edited_sha256 == digest("abcdab") and alone.near_next == 1.0
    assert winnow.compared(spark.createDataFrame([], schema)).collect() == []


def test_no_python_in_the_plan(spark, smallest):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        queries.QUERIES["op2_fingerprints"](spark, smallest).explain("formatted")
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert bad not in text.getvalue()
