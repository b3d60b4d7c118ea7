"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and odd columns."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from catloom.llm import common, hmm, jaccard, language, mixing, neighbours, outliers, quality_model, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, g string, key string"
LONG = "lorem ipsum dolor sit amet " * 8000
TEXTS = [None, "", " \n\t", "12 34 !!", "the cat sat on the mat and was " + "very " * 30 + "happy", LONG, "one two three", "one two three", "ONE two\tthree"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", None, "x", "y", "z") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[6], (None, "no id here", None, None, 1, None, None, None)], SCHEMA)


def test_language(spark, docs):
    rows = [(i, t, lang) for i in range(40) for t, lang in (("the house and the dog", "en"), ("das haus und der hund", "de"), ("la maison et le chien", "fr"), ("la casa y el perro", "es"))]
    labelled = spark.createDataFrame([*rows, (None, "x", "en"), (1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string")
    model = language.train(labelled)
    assert model.families == ["germanic", "romance"] and model.members == [["de", "en"], ["es", "fr"]]
    got = language.identify(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in got[:4]] == ["und"] * 4 and got[4].lang_pred in ("de", "en", "es", "fr")
    for text, lang in (("der hund und das haus", "de"), ("le chien et la maison", "fr"), ("el perro y la casa", "es")):
        assert model.predict(text.encode())[0] == lang
    assert language.fit([]).predict(b"text") == ("und", 0.0)
    one = language.train(labelled.where("lang = 'en'"))
    assert one.predict(b"anything")[0] == "en"
    assert language.identify(docs.limit(0), one).count() == 0


def repeated(words):
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    places = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            places.update(range(i, i + 8))
    return len(places)


def test_base_statistics(spark, docs):
    texts = [(i, t) for i, t in enumerate([None, "", "a b " * 20, "a b c d e f g h x a b c d e f g h", "# $x\n# $x\n\n \n\u00a0é|&", "l\nm\nl\nl"])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for r in outliers.base_statistics(df, "doc_id").collect():
        t = dict(texts)[r.doc_id] or ""
        words = t.encode().split()
        lines = [x for x in t.split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(len(w.decode()) for w in words), repeated(words))
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)))
    got = outliers.judge(docs).collect()
    assert len(got) == docs.count() and not any(r.kept and r.base_failed for r in got)
    assert {r.doc_id: r.base_failed for r in got}[5] and outliers.judge(docs.limit(0)).count() == 0
    assert outliers.judge(docs, *docs.columns).columns[: len(docs.columns)] == docs.columns


def test_outliers_equal_a_plain_computation(spark):
    """The same concentration steps in numpy, over one group."""
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(1500, 60, 400), np.abs(rng.normal(0, 200, 400)), np.zeros(400), np.zeros(400)])
    x[:80] = x[:80] * [1, 0, 0, 0] + [0, 4500, 0, 2000]
    x = np.rint(x).astype(int)
    df = spark.createDataFrame([("g", *map(int, r)) for r in x], "g string, x1 long, x2 long, x3 long, x4 long")
    got = outliers.distance(df.join(outliers.estimates(df), "g")).select("x1", "x2", "x4", "d2", "scale").collect()
    floors = np.diag(np.square(outliers.FLOORS, dtype=float))

    def squared(mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    def quartile(v, q):
        return np.sort(v)[max(math.ceil(q * len(v) / 4) - 1, 0)]

    spread = [((quartile(v, 3) - quartile(v, 1)) / 1.349) ** 2 + f * f for v, f in zip(x.T, outliers.FLOORS)]
    starts = [(np.array([quartile(v, 2) for v in x.T]), np.diag(spread)), (x.mean(0), np.cov(x.T, bias=True) + floors)]
    best = None
    for mean, cov in starts:
        for _ in range(outliers.STEPS):
            bins = np.floor(64 * np.log(1 + squared(mean, cov)))
            nearer = np.array([(bins < b).sum() for b in bins])
            kept = x[4 * nearer < 3 * len(x)]
            mean, cov = kept.mean(0), np.cov(kept.T, bias=True) + floors
        if best is None or np.linalg.det(cov) < best[0]:
            best = (np.linalg.det(cov), mean, cov)
    want = sorted(squared(*best[1:]))
    assert np.allclose(sorted(r.d2 for r in got), want)
    rejected = [r.d2 > outliers.CUTOFF * r.scale for r in got]
    assert sum(rejected) == 80 and all(r.x4 == 2000 for r, bad in zip(got, rejected) if bad)


@pytest.mark.parametrize("copies", [False, True])
def test_a_third_and_more_of_junk_is_rejected(spark, copies):
    """35 % junk in one language and source, each of its own or copies of one text: all of it goes, all else stays."""
    rng = np.random.default_rng(8)
    clean = [" ".join("w" * n for n in rng.integers(3, 8, 120) + rng.integers(0, 2)) for _ in range(390)]
    # Windows of eight words differ, so that only the symbols tell.
    clean = [" ".join(f"{w[:-1]}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j, w in enumerate(t.split())) for t in clean]
    one = " ".join(f"{w}{'#' if j % 2 else ''}" for j, w in enumerate(clean[0].split()))
    junk = [one if copies else " ".join(f"{w}{'#' if j % int(rng.integers(2, 5)) == 0 else ''}" for j, w in enumerate(t.split())) for t in clean[:210]]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string, source string")
    got = outliers.judge(df).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if not r.kept} == set(range(390, 600))


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 24)).astype(np.float32)
    x[100:160] = x[7]
    rows = [(i, v.tolist(), "c", 1) for i, v in enumerate(x)]
    odd = [(900, None, "c", 1), (901, [0.0] * 24, "c", 1), (902, [float("nan")] * 24, "c", 1), (903, [float("inf")] * 24, "c", 1), (904, [None, 1.0], "c", 1), (905, [], "c", 1), (None, [1.0] * 24, "c", 1), (906, [1.0, 2.0], "c", 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, code string, block int")
    index = neighbours.build_index(df)
    assert index.count() == 601
    queries = index.where("vec_id % 20 = 0 or vec_id in (7, 906)").select("vec_id", "embedding", "size")
    found, right = {}, 0
    for r in neighbours.search(index, queries, block=150, per_task=16).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in [7, *range(0, 600, 20)]:
        scores = (x.astype(float) * x[q].astype(float)).sum(1)
        scores[q] = -np.inf
        want = np.lexsort((np.arange(600), -scores))[:20]
        got = sorted(found[q])
        assert [r for r, _, _ in got] == list(range(1, 21))
        assert all(abs(s - scores[v]) < 1e-9 for _, v, s in got)
        right += len({v for _, v, _ in got} & set(want))
    assert right >= 0.9 * 20 * 31 and [v for _, v, _ in sorted(found[7])] == list(range(100, 120)) and 906 not in found
    assert neighbours.search(index.limit(0), queries.limit(0)).count() == 0


def test_mix(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(r.copies <= 2 and r.taken == r.copies * r["size"] for r in got)
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    assert all(r.source_size == sizes[r.source] and r.target <= 2 * r.source_size + 1e-9 for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * sum(sizes.values())) < 1e-6
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(docs.where("doc_id < 3")).count() == 3
    many = spark.createDataFrame([(i, "w " * (i % 50), f"s{i % 3}") for i in range(3000)], "doc_id long, text string, source string")
    for r in mixing.mix(many).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 100


def test_urls(spark):
    pages = spark.createDataFrame(
        [(i, u, "h", "p", "r", "v") for i, u in enumerate([None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x", "x://net", "x://net/", "x://a.net?q/", "x://example.com/de/#", "x://example.com/d", "x://notexample.com/de/", "x://b.org/fr/a://y", "x://é.net/"])],
        "page_id long, url string, host string, path string, rule string, verdict string",
    )
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), (None, "/", "block"), ("a", None, "block"), ("net", "/", "block")], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[5] == ("net", "", None, "allow") and got[6] == ("net", "/", "net/", "block") and got[7] == ("a.net", "", None, "allow")
    assert got[8][2:] == ("example.com/de/", "block") and got[9][2:] == got[10][2:] == (None, "allow")
    assert got[11][2:] == ("org/fr/", "allow") and got[12] == ("é.net", "/", "net/", "block")
    assert {r.verdict for r in urls.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(20000).selectExpr("concat('k', id) AS key")
    cascade = urls.build_cascade(universe.where("substr(key, 2) % 37 = 0"), universe)
    assert len(cascade.levels) > 1
    wrong = universe.where(cascade.contains(F.col("key")) != (F.substring("key", 2, 9).cast("int") % 37 == 0))
    assert wrong.count() == 0


def test_hmm_is_exact_and_handles_odd_rows(spark, docs):
    rng = np.random.default_rng(4)
    model = hmm.Model(np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]), rng.dirichlet(np.ones(5), 2).T)
    texts = [rng.integers(0, 5, n).astype(np.int32) for n in (1, 2, 7, 4, 1, 3)]

    def likely(text):
        a = model.start * model.emit[text[0]]
        for w in text[1:]:
            a = a @ model.move * model.emit[w]
        return math.log(a.sum())

    total, starts, moves, numbers, sums = hmm.expected(model, texts)
    assert abs(total - sum(map(likely, texts))) < 1e-6
    assert abs(starts.sum() - len(texts)) < 1e-4 and abs(moves.sum() - sum(len(t) - 1 for t in texts)) < 1e-3
    assert np.allclose(sums.sum(1), [sum((t == n).sum() for t in texts) for n in numbers], atol=1e-3)
    own = docs.withColumn("held_out", F.coalesce(F.col("doc_id") % 3 == 2, F.lit(False)))
    got = hmm.score_documents(own).collect()
    counts = {}
    for r in own.where("not held_out").collect():
        for w in [*(r.text or "").lower().split(), ""]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        tokens = [*(texts[r.doc_id] or "").lower().split(), ""]
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), n)
        assert abs(r.base_score - base) < 1e-6 * len(tokens) and math.isfinite(r.score) and r.score < 0
    assert hmm.score_documents(own.limit(0)).count() == 0
    assert {r.score for r in hmm.score_documents(own.withColumn("held_out", F.lit(True))).collect()} == {0.0}


def test_long_texts_shape_the_states(spark):
    """One text of 101,000 words, runs of eight overlapping vocabularies: rounds go on until the states tell them apart."""
    rng = np.random.default_rng(9)
    topic = rng.integers(0, 8, 2000).repeat(60)[:101_000]
    text = " ".join(f"w{n}" for n in topic * 15 + rng.integers(0, 30, len(topic)))
    df = spark.createDataFrame([(1, text, False)], "doc_id long, text string, held_out boolean")
    r = hmm.score_documents(df).first()
    assert (r.score - r.base_score) / r.n_tokens > 0.5


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(hmm, "KNOWN", 2)
    monkeypatch.setattr(hmm, "EMITTED", 1)
    df = spark.createDataFrame([(1, "a a a b b c", False), (2, "a b c d", True)], "doc_id long, text string, held_out boolean")
    got = {r.doc_id: r for r in hmm.score_documents(df).collect()}
    want = sum(math.log10((c + 1) / (7 + 4 + 1)) for c in (3, 2, 1, 0, 1))
    assert abs(got[2].base_score - want) < 1e-9 and (got[2].n_tokens, got[2].n_known) == (5, 4)


def test_no_rank_cap_on_emissions(spark):
    """40,000 different words, each twice, in texts of one of two kinds: also the rarest ones lean to a state."""
    words = [[f"{kind}{i}" for i in range(20_000)] for kind in "ab"]
    parts = [w[i : i + 50] * 2 for w in words for i in range(0, 20_000, 50)]
    df = spark.createDataFrame([(i, " ".join(p), False) for i, p in enumerate(parts)], "doc_id long, text string, held_out boolean")
    counts = hmm.count_words(df)
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    _, _, soft = hmm.train(hmm.encode(df), counts, total, distinct)
    rows = soft.where("token <> X''").select("n", *[f"c{k}" for k in range(hmm.STATES)]).collect()
    assert len(rows) == 40_000 and all(abs(sum(r[1:]) - r.n) < 1e-3 for r in rows)
    assert sum(max(r[1:]) > 0.6 * r.n for r in rows) > 0.9 * len(rows)


def test_rounds_leave_one_small_table(spark, monkeypatch):
    """Counts of a round take half the room of numbers by word and state, and go when the next round is written."""
    rounds = []
    monkeypatch.setattr(hmm, "keep", lambda df, purpose, *by, **more: (kept := common.keep(df, purpose, *by, **more), rounds.append((purpose, kept.inputFiles())))[0])
    rows = [(i, " ".join(f"{'ab'[i % 2]}{i * 40 + k}" for k in range(40)) * 2, i % 7 == 2) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    assert hmm.score_documents(df).count() == 500
    sizes = [[os.path.getsize(f[7:]) for f in files if os.path.exists(f[7:])] for purpose, files in rounds if purpose == "hmm-round"]
    assert len(sizes) > 1 and not any(sizes[:-1]) and 0 < sum(sizes[-1]) < 32 * 500 * 40


def test_quality(spark, docs):
    rows = [(i, "clean words in order here" if i % 2 else "junk ### $$$ ||| junk", i % 2) for i in range(200)]
    labelled = spark.createDataFrame([*rows, (None, "x", 1), (5, None, 0), (6, "x", None), (7, "x", 7)], "doc_id long, text string, quality int")
    model = quality_model.train(labelled, labelled)
    got = quality_model.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert len({r.score for r in got[:3]}) == 1
    assert model.score(quality_model.features(b"clean words here")) > 0.7 > 0.3 > model.score(quality_model.features(b"### junk |||"))
    assert quality_model.fit([], np.zeros(0, bool)).score(np.zeros(0, int)) == pytest.approx(0.5)
    assert quality_model.score(docs.limit(0), model).count() == 0


def test_links(spark, docs):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.link_components(docs).collect()}
    assert got[6, 1] == got[7, 1] == got[8, 1] == 6 and got[0, 0] == 0 and got[2, 0] == 2 and got[None, 1] is None
    assert jaccard.link_components(docs).count() == docs.count() and jaccard.link_components(docs.limit(0)).count() == 0
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(12):
        words = [f"w{n}" for n in rng.integers(0, 5000, rng.integers(6, 120))]
        for _ in range(12):
            copy = [w if rng.random() > 0.02 else f"x{rng.integers(1 << 30)}" for w in words]
            texts.append(" ".join(copy[: rng.integers(max(5, len(copy) * 3 // 4), len(copy) + 1)]))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in jaccard.link_components(df).collect():
        assert (r.component_id, r.n_shingles) == (find(r.doc_id), len(sets[r.doc_id]))


def test_prefixes_of_linked_sets_meet():
    """Sets around the threshold, most tokens common, in one order of all tokens: linked ones share what the matrix asks for."""
    rng = np.random.default_rng(7)
    met = 0
    for _ in range(3000):
        shared, rest = int(rng.integers(1, 150)), rng.integers(0, 40, 2)
        a, b = [np.sort(rng.permutation(400)[:shared])] * 2
        a, b = [np.unique(np.concatenate([s, rng.integers(400 * (i + 1), 400 * (i + 2), r)])) for i, (s, r) in enumerate(zip((a, b), rest))]
        a, b = sorted((a, b), key=len)
        if not jaccard.links(shared, len(a), len(b)):
            continue
        order, rare = rng.permutation(1200), int(rng.integers(0, 1200))
        small, large = a[np.argsort(order[a])], b[np.argsort(order[b])]
        _, listed, need = jaccard.prefixes(len(a), int((order[a] < rare).sum()))
        asks, _, _ = jaccard.prefixes(len(b), int((order[b] < rare).sum()))
        assert len(np.intersect1d(small[:listed], large[:asks])) >= need
        met += 1
    assert met > 500


def test_pipeline_stages(spark, docs):
    sf = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{sf}/documents.parquet")
    for given in (table, table.limit(0)):
        stages = dict(corpus_pipeline.STAGES)
        kept = stages["quality_rules"](spark, given, sf)
        want = {r.doc_id for r in outliers.judge(given).where("kept").collect()}
        assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == want
        good = stages["quality_classifier"](spark, kept, sf)
        assert good.columns == table.columns and good.count() <= kept.count()
        one = stages["near_duplicates"](spark, kept, sf)
        assert sorted(r.doc_id for r in one.collect()) == sorted({r.component_id for r in jaccard.link_components(kept).collect()})
        mixed = stages["mix"](spark, one, sf)
        copies = {r.doc_id: r.copies for r in mixing.mix(one).collect() if r.copies}
        assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies
        packed = stages["pack"](spark, mixed, sf)
        assert packed.where("piece = 0").count() == mixed.count()
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, sf)
