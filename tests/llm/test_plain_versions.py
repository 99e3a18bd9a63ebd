"""The classifier, the token files and the whole pipeline against plain versions and on odd rows."""

import bisect
import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyarrow import orc
from pyspark.sql import functions as F

import corpus_pipeline
from lexigrain.llm import mixing, quality_model, quality_rules, token_files
from lexigrain.llm.common import words_of
from lexigrain.llm.pieces import library_tokenizer, tokenizer_path
from tests.llm.test_selection import LONG, TEXTS

FOLDER = "/root/testdata/sf0.01"


# ------------------------------------------------------------------------- classifier
def plain_features(text):
    words = words_of(text)
    if not words:
        return [0.0] * len(quality_model.FEATURES)
    data = [b for b in text.encode() if b not in b" \t\n\x0b\x0c\r"]
    count = lambda chars: sum(b in chars for b in data)
    upper, lower = count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count(b"abcdefghijklmnopqrstuvwxyz")
    digits, symbols, marks, shouts = count(b"0123456789"), count(b"#*$%&|<>"), count(b".,;:?'\"()-"), count(b"!")
    n, solid = len(words), len(data)
    lines = [line for line in text.split("\n") if words_of(line)]
    return [
        math.log1p(n), solid / n, upper / max(1, upper + lower), digits / solid, symbols / solid, marks / solid, shouts / solid,
        len(set(words)) / n**0.8, len(set(zip(words, words[1:]))) / max(1, n - 1), max(Counter(words).values()) / n, len(lines) / n,
        1 - len(set(lines)) / max(1, len(lines)), (solid - upper - lower - digits - symbols - marks - shouts) / solid,
        math.log1p(max(map(len, words))),
    ]


def plain_score(model, features):
    bins = [bisect.bisect_right(border.tolist(), value) for border, value in zip(model.borders, features)]
    logit = model.intercept + sum(float(table[at]) for table, at in zip(model.tables, bins))
    logit += sum(float(table[bins[a]][bins[b]]) for (a, b), table in model.pairs.items())
    return 1 / (1 + math.exp(-max(-30, min(30, logit))))


@pytest.fixture(scope="module")
def learned(spark):
    return quality_model.learn(*(spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels")))


def test_scores_are_sums_of_table_entries(spark, learned):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, TEXTS[4]), (None, None), (10**6, LONG), (10**6, LONG)], "doc_id long, text string")
    texts = [(row.doc_id, row.text or "") for row in rows.union(odd).collect()]
    found = sorted((str(row.doc_id), round(row.score, 9)) for row in quality_model.score(rows.union(odd), learned).collect())
    assert found == sorted((str(at), round(plain_score(learned, plain_features(text)), 9)) for at, text in texts)


def test_trees_take_the_best_cut_of_all():
    draw = np.random.default_rng(2)
    gain = lambda g, w: g.sum() ** 2 / (w.sum() + 2.0)
    for _ in range(60):
        g, w = draw.normal(size=9), draw.random(9)
        parts = [(0, 9)]
        for _ in range(3):  # the best of all cuts of all parts, one after the other
            options = [
                (gain(g[a:c], w[a:c]) + gain(g[c:b], w[c:b]) - gain(g[a:b], w[a:b]), (a, b), c) for a, b in parts for c in range(a + 1, b)
            ]
            best = max(options)
            if best[0] <= 1e-9:
                break
            parts.remove(best[1])
            parts += [(best[1][0], best[2]), (best[2], best[1][1])]
        want = np.zeros(9)
        for a, b in parts:
            want[a:b] = g[a:b].sum() / (w[a:b].sum() + 2.0)
        assert quality_model.shallow_tree(g, w, 3, 2.0) == pytest.approx(want)


# ------------------------------------------------------------------------- token files
def rows_read(frame):
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numOutputRows").get().value()


def test_stripes_index_and_bloom_filters_prune(spark, tmp_path):
    rows = spark.range(60_000).select((2 * F.col("id")).alias("doc_id"), F.concat(F.lit("a few words "), "id").alias("text"))
    path = str(tmp_path / "tokens")
    token_files.write_tokens(rows.repartition(4), path, stripe_bytes=100_000)
    stripes = [orc.ORCFile(str(file)).nstripes for file in (tmp_path / "tokens").glob("*.orc")]
    assert sum(stripes) > len(stripes)
    stored = token_files.read_tokens(spark, path)
    assert rows_read(stored.select("doc_id")) == 60_000
    # Within the ranges of ids that statistics know, an odd id is ruled out by Bloom filters alone.
    absent = [rows_read(stored.where(F.col("doc_id") == at).select("doc_id", "ids")) for at in range(10_001, 110_000, 9_998)]
    assert sum(n == 0 for n in absent) >= len(absent) - 1
    assert 0 < rows_read(stored.where("doc_id = 40000").select("doc_id", "ids")) <= 20_000


# ---------------------------------------------------------------------------- pipeline
def shingles(text):
    words = text.encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def plain_representatives(texts):
    """The smallest id of every group of texts linked by a similarity of 0.8, by all pairs."""
    sets = {at: shingles(text) for at, text in texts.items()}
    parent = {at: at for at in texts}

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    ids = sorted(texts)
    for place, a in enumerate(ids):
        for b in ids[place + 1 :]:
            if sets[a] and sets[b] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])):
                shared = len(sets[a] & sets[b])
                if 5 * shared >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return {at for at in ids if not sets[at] or root(at) == at}


def sql_rows(query, rows):
    connection = duckdb.connect()
    connection.register("documents", pa.Table.from_pylist(rows))
    found = connection.sql(f"SELECT * FROM ({query})")
    return [dict(zip(found.columns, row)) for row in found.fetchall()]


def test_pipeline_equals_its_plain_version(spark, learned):
    rows = [row.asDict() for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = [row for row in rows if plain_score(learned, plain_features(row["text"] or "")) >= quality_model.THRESHOLD]
    kept = {row["doc_id"] for row in sql_rows(quality_rules.ORACLE, rows) if row["kept"]}
    rows = [row for row in rows if row["doc_id"] in kept]
    first = plain_representatives({row["doc_id"]: row["text"] for row in rows})
    rows = [row for row in rows if row["doc_id"] in first]
    taken = {row["doc_id"]: -(-row["taken"] // row["size"]) if row["size"] else 0 for row in sql_rows(mixing.ORACLE, rows)}
    tokenizer = library_tokenizer(tokenizer_path("word_bpe_49k.json"))
    want = []
    for row in rows:
        ids = tokenizer.encode(row["text"], add_special_tokens=False).ids
        decoded = hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want += [(row["doc_id"], row["source"], len(ids), tuple(ids), decoded)] * taken[row["doc_id"]]
    found = [(r.doc_id, r.source, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and len(found) > 200


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Null ids and sources, repeated rows, empty, null and very long texts, and an empty table."""
    good = [row.text for row in spark.read.parquet(f"{FOLDER}/documents.parquet").where("lang = 'en' AND n_chars BETWEEN 900 AND 2500").limit(40).collect()]
    rows = [(at if at % 5 else None, text, "en", f"s{at % 3}" if at % 7 else None, len(text), "extra") for at, text in enumerate(good)]
    rows += [rows[6], rows[7], (None, None, None, None, None, ""), (None, "", "en", "s1", 0, ""), (900, " ".join(good * 40), "en", "s1", 1, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")
    labels = spark.createDataFrame([(at, at % 2, 0) for at in range(1, 40)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.n_tokens == len(r.ids) for r in found)
    docs, columns = frame, frame.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name != "quality_classifier":  # every other stage is given all rows
            left = stage(spark, docs, str(tmp_path))
            assert left.columns == columns and left.count() <= 3 * docs.count(), name
    texts = {row.text for row in corpus_pipeline.drop_near_copies(spark, frame, "").collect()}
    assert set(good) <= texts | {" ".join(good * 40)}  # no clean text goes, whatever its id
    empty = tmp_path / "empty"
    labels.write.parquet(str(empty / "labels.parquet"))
    frame.limit(0).write.parquet(str(empty / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
