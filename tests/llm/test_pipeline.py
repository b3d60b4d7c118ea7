"""The pipeline's stages against plain Python, on rows with repeated and missing ids and clashing columns."""

import hashlib
import math
import random
from collections import Counter

import corpus_pipeline

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, copies int, score string, predicted string, "
    "kept string, n_words string, component_id long, row_key string, copy string, id string"
)


def made(spark):
    draw = random.Random(8)
    texts, rows = [], []
    for _ in range(30):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.randint(30, 90))]
        texts.append(words)
        for _ in range(draw.randint(0, 3)):
            texts.append([w if draw.random() > 0.02 else f"x{draw.randrange(1 << 30)}" for w in words])
    draw.shuffle(texts)
    for i, words in enumerate(texts):
        # A third without id, some ids on several texts.
        doc = None if i % 3 == 0 else i // 2
        rows += [(doc, " ".join(words), "en", draw.choice(["a", "b", None]), None, 5, "s", "p", "k", "n", 1, "r", "c", "i")] * draw.choice([1, 1, 2])
    rows += [(900 + i, t, None, "a", None, 0, None, None, None, None, None, None, None, None) for i, t in enumerate([None, "", " \n"])]
    return spark.createDataFrame(rows, SCHEMA), rows


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def survivors(rows):
    """(doc_id, size of the component) of one row of each component."""
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i])
    return [min((r[0] is None, r[0] or 0) for r in m) for m in members.values()]


def test_one_row_of_each_component(spark):
    docs, rows = made(spark)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    got = kept.collect()
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(survivors(rows))
    assert not Counter(map(tuple, got)) - Counter(rows)
    # Nothing left links: no group stayed twice, and each text dropped links with others that stayed or went.
    left = [shingles(r.text) for r in got]
    assert not any(a and 100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(left) for b in left[:i])


def aims(sizes):
    """Each source's target: shares by weight, those at their caps fixed one after the other."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    rest, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (rest - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        fixed |= {s: 2 * sizes[s] for s in over}


def test_mix_by_prefix_sums(spark):
    docs, rows = made(spark)
    mixed = corpus_pipeline.mix(spark, docs, "")
    assert mixed.columns == docs.columns
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = Counter()
    for source, target in aims(dict(sizes)).items():
        share = math.floor(target / sizes[source] * (1 << 24) + 0.5)
        end = int(hashlib.md5(("mix" + ("\0" if source is None else source)).encode()).hexdigest()[:6], 16)
        for r in sorted((r for r in rows if r[3] == source), key=lambda r: (len((r[1] or "").split()), r[0] is not None, r[0] or 0)):
            end += share
            want[r[0], source, len((r[1] or "").split())] += (end >> 24) - ((end - share) >> 24)
    got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in mixed.collect())
    assert got == +want


def test_texts_are_kept_small_and_judged_where_they_are(spark, capsys):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows, key = corpus_pipeline.numbered(docs)
    assert all(f.endswith(".zstd.parquet") for f in rows.inputFiles())
    assert rows.select(key).distinct().count() == docs.count()
    rules = corpus_pipeline.quality_rules(spark, docs, "")
    assert all(f.endswith(".zstd.parquet") for f in rules.inputFiles() if "/statistics-" in f)
    capsys.readouterr()
    rules.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_stages_take_clashing_columns(spark):
    docs, _ = made(spark)
    rules = corpus_pipeline.quality_rules(spark, docs, "")
    good = corpus_pipeline.quality_classifier(spark, rules, "/root/testdata/sf0.001")
    for stage in (rules, good):
        assert stage.columns == docs.columns
        assert not Counter(map(tuple, stage.collect())) - Counter(map(tuple, docs.collect()))
