import re
from collections import Counter, defaultdict

import compare
import pytest

from rentloom.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    """The audit, straight from its definition."""
    found, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        found[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = set()
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= least]
        groups = {s: c for (x, s), c in found.items() if x == lang}

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), Counter()))
        for s in groups:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, values, most in (("pair", pair, None), ("term", term, top)):
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                out |= {(lang, s, part, x, v, i) for i, (v, x) in enumerate(values[:most], 1)}
    return out


def odd_rows():
    words = ["Ärger", "ärger", "the", "The", "été", "中文", "a b", "x1y", "zzz", "İ", "ſ", "_u_", "q" * 3000]
    rows = [("en", f"s{i % 7}", " ".join(words[j % len(words)] for j in range(i, i * 3 % 17 + i))) for i in range(90)]
    rows += [(None, None, "the the zzz"), (None, "s1", None), ("en", None, ""), ("en", "none", "12 34"), ("xx", "only", "word"),
             ("", "s1", "the"), ("yy", "a", None), ("yy", "b", "rare")]
    return rows + rows[:5]


@pytest.mark.parametrize("groups, terms, held", [(2, 3, 400_000), (64, 4096, 4), (1, 1, 400_000)])
def test_equals_the_definition_whatever_the_blocks(spark, monkeypatch, groups, terms, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "lang string, source string, text string, doc_id long, term string")
    got = [tuple(r) for r in divergence.audit(docs, 3, 2, groups, terms).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, 3, 2)


def test_equals_sql(spark, smallest):
    got = queries.QUERIES["op13_divergence"](spark, smallest)
    assert compare.differences(got, compare.duck(smallest), queries.SQL["op13_divergence"]) == []


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(docs).collect() == []


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    count, total = 10**13 + 7, 10**14 + 3
    row = spark.range(1).select(divergence.share(F.lit(count), F.lit(total), F.lit(11)).alias("p")).first()
    assert row.p == 1 + 10**9 * (count + 5) // (total + 55)
