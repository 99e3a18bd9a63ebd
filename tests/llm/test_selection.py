"""Rules, classifier, mixing and the pipeline on small tables, against plain versions."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexigrain.llm import mixing, quality_model, quality_rules
from lexigrain.llm.common import words_of

FOLDER = "/root/testdata/sf0.001"
LONG = "one two three four five six seven eight nine ten " * 700
TEXTS = [
    None,
    "",
    " \n ",
    "short text",
    "the quick brown fox jumps over the lazy dog and runs to the hills of home",
    "the quick brown fox jumps over the lazy dog and runs to the hills of home",
    LONG,
    "# " * 40 + "the of and to in",
    "a line of the text\n" * 9 + "and one more",
    "w " * 6 + "x y z a b c d e f g h i j k l m n o p",
    "ä ö ü ß" + "\x0b\x0c\r\t" * 3 + "é" * 4000,
]


def documents(spark, texts=TEXTS):
    rows = [(at, text, f"s{at % 3}" if at % 4 else None, "clash") for at, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, row string")


def counted(text):
    words = words_of(text or "")
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    repeated = {gram for gram in grams if grams.count(gram) > 1} if len(grams) < 2000 else set(grams)
    under = {k + step for k, gram in enumerate(grams) if gram in repeated for step in range(5)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(under),
    )


def test_rule_counts(spark):
    found = quality_rules.judge(documents(spark)).orderBy("doc_id").collect()
    for row, text in zip(found, TEXTS):
        assert tuple(row)[1:6] == counted(text), text and text[:40]
        assert row.base_failed == (row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words)
        assert not (row.kept and row.base_failed)
    assert [row.doc_id for row in found if row.kept] == [4, 5]
    kept = quality_rules.keep_good(documents(spark))
    assert kept.columns == documents(spark).columns and kept.count() == 2
    assert quality_rules.judge(documents(spark).limit(0)).count() == 0


def test_rule_plan_is_native(spark):
    plan = quality_rules.judge(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rules_match_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = sorted(connection.execute(quality_rules.ORACLE).fetchall())
    found = sorted(tuple(row) for row in quality_rules.judge(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect())
    assert found == want


def test_classifier_on_held_out_rows(spark):
    rows, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    found = quality_model.score(rows, quality_model.learn(rows, labels)).join(labels, "doc_id").toPandas()
    assert all(found.held_out == [zlib.crc32(str(at).encode()) % 4 == 2 for at in found.doc_id])
    held_out = found[found.held_out]
    assert (held_out.predicted == held_out.quality).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_classifier_ignores_the_held_out_fold(spark):
    rows, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_model.learn(rows, each) for each in (labels, other))
    features = np.random.default_rng(0).random((50, len(quality_model.FEATURES)))
    assert (a.scores(features) == b.scores(features)).all()


def test_classifier_edges(spark):
    rows = documents(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (99, 0)], "doc_id long, quality int")
    scored = quality_model.score(rows, quality_model.learn(rows, labels)).collect()
    assert len(scored) == len(TEXTS) and all(0 < row.score < 1 for row in scored)
    none = quality_model.learn(rows, labels.limit(0))
    assert {row.score for row in quality_model.score(rows, none).collect()} == {0.5}
    assert quality_model.keep_good(rows, none).columns == rows.columns
    assert quality_model.score(rows.limit(0), none).count() == 0


def test_interactions_are_learned():
    random = np.random.default_rng(5)
    features = random.random((4000, len(quality_model.FEATURES)))
    labels = ((features[:, 2] > 0.5) ^ (features[:, 7] > 0.5)).astype(float)
    model = quality_model.fit(features[:3000], labels[:3000])
    assert (2, 7) in model.pairs
    assert ((model.scores(features[3000:]) > 0.5) == labels[3000:]).mean() > 0.9


def plain_targets(sizes, weights, most):
    order = sorted(sizes, key=lambda name: (name is None, name))
    weight = {name: weights[at % len(weights)] for at, name in enumerate(order)}
    left, free, targets = sum(sizes.values()), set(order), {}
    while free:
        unit = left / sum(weight[name] for name in free)
        over = {name for name in free if weight[name] * unit > most * sizes[name]}
        if not over:
            return targets | {name: weight[name] * unit for name in free}
        targets |= {name: float(most * sizes[name]) for name in over}
        left -= sum(targets[name] for name in over)
        free -= over
    return targets


def test_mix_targets_and_cuts(spark):
    rows = documents(spark, [*TEXTS, *(" ".join(["w"] * n) for n in (5, 9, 1, 30, 2, 2, 2, 8, 40, 3))])
    found = mixing.mix_table(rows).toPandas()
    source = {row.doc_id: row.source for row in rows.collect()}
    found["source"] = [source[at] for at in found.doc_id]
    sizes = found.groupby("source", dropna=False)["size"].sum().to_dict()
    sizes = {None if name != name else name: int(size) for name, size in sizes.items()}
    targets = plain_targets(sizes, (1, 2, 3), 3)
    for name, part in found.groupby("source", dropna=False):
        name = None if name != name else name
        assert part.target.iloc[0] == pytest.approx(targets[name])
        assert abs(part.taken.sum() - targets[name]) <= 1
    assert (found.taken <= 3 * found["size"]).all() and (found.taken >= 0).all()
    again = mixing.mix_table(rows.repartition(5)).toPandas().set_index("doc_id").taken
    assert (again.sort_index() == found.set_index("doc_id").taken.sort_index()).all()


def test_mixed_rows_hold_the_words_taken(spark):
    rows = documents(spark)
    want = {row.doc_id: row.taken for row in mixing.mix_table(rows).collect()}
    mixed = mixing.mix(rows)
    assert mixed.columns == rows.columns
    got = dict.fromkeys(want, 0)
    for row in mixed.collect():
        got[row.doc_id] += len(words_of(row.text))
        assert TEXTS[row.doc_id].startswith(row.text) or row.text in TEXTS[row.doc_id]
    assert got == want
    assert mixing.mix(rows.limit(0)).count() == 0 and mixing.mix_table(rows.limit(0)).count() == 0


def test_mix_shares_a_cut_among_equal_rows(spark):
    rows = documents(spark, ["a b c d"]).withColumn("source", F.lit("x"))
    many = rows.union(rows).union(rows).union(spark.createDataFrame([(9, "e", None, "")], "doc_id long, text string, source string, row string"))
    found = mixing.mix_table(many).collect()
    assert len(found) == 4 and all(0 <= row.taken <= 3 * row.size for row in found)


def test_mix_matches_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = sorted(connection.execute(mixing.ORACLE).fetchall())
    found = sorted(tuple(row) for row in mixing.mix_table(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect())
    assert found == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id").quality
    ids = set(docs.toPandas().doc_id)
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_classifier"](spark, docs, "/root/testdata/sf0.01")
    assert good.columns == columns
    left = set(good.toPandas().doc_id)
    clean = {at for at in ids if labels.get(at) == 1}
    assert len(clean & left) >= 0.99 * len(clean)
    assert len([at for at in ids - clean if labels.get(at) == 0 and at in left]) <= 0.1 * (labels == 0).sum()
    ruled = stages["quality_rules"](spark, good, "/root/testdata/sf0.01")
    verdicts = {row.doc_id for row in quality_rules.judge(good).where("kept").collect()}
    assert ruled.columns == columns and {row.doc_id for row in ruled.select("doc_id").collect()} == verdicts
    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.01").toPandas()
    assert set(whole.doc_id) <= verdicts and (whole.n_tokens == whole.ids.map(len)).all()


def test_pipeline_mix_cuts_no_text(spark):
    rows = documents(spark)
    size = {at: len(words_of(text or "")) for at, text in enumerate(TEXTS)}
    taken = {row.doc_id: row.taken for row in mixing.mix_table(rows).collect()}
    assert any(n % size[at] for at, n in taken.items() if n)
    got = dict.fromkeys(taken, 0)
    for row in dict(corpus_pipeline.STAGES)["source_mix"](spark, rows, "").collect():
        assert row.text == TEXTS[row.doc_id]
        got[row.doc_id] += size[row.doc_id]
    assert all(got[at] == -(-n // size[at]) * size[at] for at, n in taken.items() if size[at])
