"""Licence scans, vector codes and collocations against their SQL and plain versions."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from catloom.llm import codes, collocations, licenses, queries_spans, registry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = ("op11_license_diagonals", "op12_slice_intersect_codes", "op13_dynamic_itemset_phrases")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    queries, oracles = registry.load()
    assert compare(spark, connect(SF), SF, queries[name], oracles[name]) == ""


# --- licences

LICENSED = {
    0: None,
    1: "",
    2: " \n-- ",
    3: "mit license",
    4: "Under the MIT-License; under the mit license. UNDER THE MIT LICENSE",
    5: "x " * 60000 + "Apache License, Version 2",
    6: "This work is licensed under the GNU Lesser General Public License, version 2.",  # a word put in, one changed
    7: "Licensed under the General Public License, version 2 0",  # covers much, tells nothing
    8: "permission is now hereby granted free of charge to any person obtaining a copy of this great software",
    9: "cc by ncé",
    10: "All rights reserved",
}


@pytest.fixture(scope="module")
def licensed(spark):
    rows = [(i, t, "x", 1, "y", 2.0, "z") for i, t in LICENSED.items()]
    rows += [rows[4], rows[4], (None, LICENSED[3], "x", 1, "y", 2.0, "z"), (4, "cc by nc", "x", 1, "y", 2.0, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, p int, words string, covered double, _doc string")


def test_licences_of_odd_rows(licensed):
    got = licenses.scan_licenses(licensed, queries_spans.PHRASES)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == licensed.count()
    by_id = {r[0]: r[1:] for r in rows if r[0] not in (4, None)}
    for i in (0, 1, 2):
        assert by_id[i] == (0, 0, None, None, "", "", 0.0)
    assert by_id[3][:2] == (2, 0) and by_id[5][:6] == (60004, 1, 60000, 60000, "apache-2", "apache-2")
    assert by_id[6][4:6] == ("", "gpl") and by_id[6][6] >= licenses.COVER
    assert by_id[7][5] == "" and by_id[8][5] == "mit" and by_id[9][5] == "" and by_id[10][5] == "all-rights-reserved"
    assert rows.count((4, 12, 3, 0, 8, "mit", "mit", 1.0)) == 3 and rows.count((4, 3, 1, 0, 0, "cc-by-nc", "cc-by-nc", 1.0)) == 1
    assert licenses.scan_licenses(licensed.limit(0), queries_spans.PHRASES).count() == 0


def test_base_places_equal_a_plain_search(spark):
    rng = np.random.default_rng(3)
    vocabulary = "under the mit license apache version 2 cc by nc".split()
    texts = [" ".join(rng.choice(vocabulary, 300)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(docs, queries_spans.PHRASES).collect():
        words = texts[r.doc_id].split()
        places = [(i, t.label) for t in queries_spans.PHRASES for i in range(len(words)) if words[i : i + len(t.text.split())] == t.text.split()]
        at = [i for i, _ in places]
        assert (r.n_base, r.first_word, r.last_word) == (len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places})) and 0 <= r.score <= 1
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_spans_stand_where_the_notice_does(spark, licensed):
    spans = {(r.doc_id, r.label): (r.start, r.end) for r in licenses.license_spans(licensed).collect()}
    assert spans[(8, "mit")] == (3, 16) and spans[(10, "all-rights-reserved")] == (0, 3)
    assert all(1 <= r.n for r in licenses.license_spans(licensed).groupBy("doc_id", "label", "start").agg(F.count("*").alias("n")).collect())
    with pytest.raises(ValueError):
        licenses.template_grams(spark, (licenses.Template("x", "two words"),))


def test_many_templates_join_by_shuffle(licensed, monkeypatch):
    want = sorted(map(str, licenses.scan_licenses(licensed, queries_spans.PHRASES).collect()))
    monkeypatch.setattr(licenses, "SMALL", 0)
    assert sorted(map(str, licenses.scan_licenses(licensed, queries_spans.PHRASES).collect())) == want


# --- codes


def test_masks_hold_the_nearest_entry():
    rng = np.random.default_rng(1)
    for spread, n in ((3, 64), (50, 64), (1 << 25, 64), (5, 1), (0, 7)):
        entries = rng.integers(-spread, spread + 1, (n, 4))
        x = np.vstack([rng.integers(-2 * spread, 2 * spread + 1, (400, 4)), entries])
        squared = np.square(x[:, None, :] - entries[None]).sum(axis=2)
        found, best = codes.Slices(entries).nearest(x)
        assert (found == squared.argmin(axis=1)).all() and (best == squared.min(axis=1)).all()


def plain_codes(rows):
    """Books and codes of (id, label, integer vector) rows, by brute force."""
    parts = {i: [v[4 * p : 4 * p + 4] for p in range(16)] for i, _, v in rows}
    ids = sorted(parts)
    books = [[parts[i][p] for i in ids[:64]] for p in range(16)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            taken = {}
            for i in ids:
                taken.setdefault(nearest(parts[i][p], books[p])[1], []).append(parts[i][p])
            books[p] = [[sum(c) // len(taken[n]) for c in zip(*taken[n])] if n in taken else e for n, e in enumerate(books[p])]
    return {i: ([nearest(parts[i][p], books[p]) for p in range(16)]) for i in ids}


def test_codes_equal_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i * 3, int(i % 4) if i % 5 else None, [float(x) for x in rng.integers(-3, 4, 64) / 256 * 9]) for i in range(150)]
    good[20] = (60, 1, good[19][2])
    odd = [(1, 1, None), (2, 1, [None] * 64), (4, 1, [float("nan")] * 64), (5, 1, [float("inf")] * 64), (7, 1, [1.0] * 32), (8, 1, [])]
    df = spark.createDataFrame([(*r, "c", 9, 9) for r in good + odd], "vec_id long, label int, embedding array<double>, code string, part int, error int")
    got = {r.vec_id: r for r in codes.compressed_with_errors(df).collect()}
    want = plain_codes([(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in good])
    assert set(got) == set(want)
    sums = Counter()
    for i, label, _ in good:
        assert got[i].code == "".join(f"{n:02x}" for _, n in want[i]) and got[i].error == sum(d for d, _ in want[i])
        sums[label] += got[i].error
    assert all(got[i].label_error == sums[label] for i, label, _ in good)
    assert len({r.codebooks_sha256 for r in got.values()}) == 1 and codes.compressed_with_errors(df.limit(0)).count() == 0


def test_few_repeated_and_huge_vectors(spark):
    rows = [(1, None, [1e300] * 32 + [0.0] * 32), (1, None, [-1e300] * 32 + [0.0] * 32), (None, 2, [0.5] * 64), (None, 2, [0.5] * 64)]
    got = codes.compressed_with_errors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert len(got) == 4 and all(r.error >= 0 and len(r.code) == 32 for r in got)


# --- collocations


def plain_collocations(rows, least, top):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = {}, Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(fold)):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f.setdefault(lang or "und", Counter())[tuple(words[i : i + m])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        ranked = []
        for p, a in often.items():
            longer = [b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if len(p) > 1 and not any(100 * b >= 80 * a for b in longer):
                score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def test_a_tag_holds_length_scan_and_place(spark):
    want = [(1, 0, 0), (4, 3, 77), (2, 254, (1 << 23) - 1), (3, 255, (1 << 30) + 5)]
    tags = spark.createDataFrame([(int(collocations.tagged(*w)),) for w in want], "tag long")
    fields = tags.selectExpr(collocations.LENGTH, collocations.SINCE, collocations.SLOT)
    assert [tuple(r) for r in fields.collect()] == want


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_collocations_equal_a_plain_count(spark, monkeypatch, shards):
    monkeypatch.setattr(collocations, "BLOCK", 2000)
    rng = np.random.default_rng(4)
    words = "a A b c dé É \x1c x y a. b, c; d: e! f? \tg \n \r\n k".split(" ")
    rows = [(("en", None, "de", "en")[i % 4], " ".join(rng.choice(words, rng.integers(0, 80)))) for i in range(200)]
    rows += [("en", None), ("fr", ""), (None, "  \t\n"), ("de", "a b c " * 20000)] + [("en", "hot hot hot phrase")] * 150
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "lang string, text string, n int, key string").repartition(3)
    phrases, totals = collocations.frequent_phrases(df, 4, shards)
    want = plain_collocations(rows, 4, 50)
    monkeypatch.setattr(collocations, "frequent_phrases", lambda docs, threshold: (phrases, totals))
    got = sorted(tuple(r) for r in collocations.collocations(df, 50, 4).collect())
    assert got == want


def test_a_coarse_table_changes_nothing(spark, monkeypatch):
    """Phrases that share a slot are counted too early at most."""
    rows = [("en", f"w{i % 7} w{i % 3} w{i % 5} tail {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "lang string, text string")
    want = sorted(tuple(r) for r in collocations.collocations(df, 50, 5).collect())
    assert want == plain_collocations(rows, 5, 50)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_phrases_that_share_a_place_are_counted_whole(spark):
    """"rare mid end" builds on "rare mid", whose place an earlier phrase marks before "rare" is frequent."""
    mask, times = np.uint64(collocations.SLOTS - 1), np.uint64(0xC2B2AE3D27D4EB4F)

    def hashes(words):
        return np.array([xxhash.xxh3_64_intdigest(f"en\t{w}".encode()) for w in words], np.uint64)

    rare, common = [f"r{i}" for i in range(20000)], [f"c{i}" for i in range(20000)]
    at = [collocations._mixed(h) & mask for h in (hashes(rare) * times + hashes(["mid"]), hashes(["mid"]) * times + hashes(common))]
    _, i, j = np.intersect1d(*at, return_indices=True)
    x, y = rare[i[0]], common[j[0]]
    rows = [("en", f"mid end. mid {y}")] * 240 + [("en", f"{x} mid end")] * 36
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = sorted(tuple(r) for r in collocations.collocations(df).collect())
    assert got == plain_collocations(rows, 30, 50)


@pytest.mark.parametrize("shards", [3, 4])
def test_few_places_change_nothing(spark, shards):
    rng = np.random.default_rng(shards)
    rows = [("en", " ".join(f"w{int(k)}" for k in rng.zipf(1.3, rng.integers(5, 60)) if k < 90)) for _ in range(400)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    found, _ = collocations.frequent_phrases(df, 8, shards, 32)
    want = Counter()
    for _, text in rows:
        w = text.split()
        want.update(" ".join(w[i : i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    assert {r.phrase: r.n for r in found.collect()} == {p: a for p, a in want.items() if a >= 8}
