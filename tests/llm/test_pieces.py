"""Encoders against the library, edits against fresh encodings."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexigrain.llm import prefix_bpe, token_counts, token_files
from lexigrain.llm.common import split_words
from lexigrain.llm.pieces import LibraryEncoder, library_tokenizer, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
ODD = [
    None,
    "",
    "   \n\t",
    "a<|endoftext|>b c's '<|startoftext|><|endoftext|> ' x '",
    "ΑΣ Σ ΣΑ\x1cb\xa0c\x85d",
    "é ́x É İstanbul ǅ it's IT'S we'RE 123 ½ x²",
    "日本語 テスト 🙂🙂‍🔥 한국어 각",
    "　x   y <|x",
    "thththththth " * 3000,
    "x" * 5000,
    "abcab" * 20_000 + " é" * 3,
]


def library(text):
    return library_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("encoder", [LibraryEncoder(PATH).encode, None])
def test_ids_are_the_librarys(encoder):
    trie = prefix_bpe.trie_encoder(PATH)
    for text in ODD:
        found = encoder(split_words(text or "")) if encoder else trie.encode_texts([text or ""])[0]
        assert np.frombuffer(found, "<i4").tolist() == library(text)


def test_words_of_the_tables(spark):
    texts = [row.text for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    trie = prefix_bpe.trie_encoder(PATH)
    for found, text in zip(trie.encode_texts(texts), texts):
        assert np.frombuffer(found, "<i4").tolist() == library(text)


def test_encode_and_decode(spark):
    rows = documents(spark, ODD).withColumn("tokens", F.lit(1))
    found = prefix_bpe.decode(prefix_bpe.encode(rows)).orderBy("doc_id").collect()
    assert [row.ids for row in found] == [library(text) for text in ODD]
    decode = library_tokenizer(PATH).decode
    assert [row.decoded for row in found] == [decode(library(text), skip_special_tokens=False) for text in ODD]
    digests = prefix_bpe.encode_decode_digests(rows).orderBy("doc_id").collect()
    for row, text in zip(digests, ODD):
        assert row.n_tokens == len(library(text))
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, library(text))).encode()).hexdigest()
    with pytest.raises(ValueError):
        prefix_bpe.encode(rows.withColumn("IDS", F.lit(1)))
    assert prefix_bpe.encode(rows.limit(0)).count() == 0


def test_token_files_round_trip(spark, tmp_path):
    import zlib

    rows = documents(spark, ODD).union(documents(spark, ["repeated id"])).withColumn("part", F.lit("clash"))
    path = str(tmp_path / "tokens")
    found = token_files.token_file_digests(rows, path).orderBy("start").collect()
    assert [row.doc_id for row in found] == sorted([*range(len(ODD)), 0])
    start = 0
    texts = sorted([*enumerate(ODD), (0, "repeated id")], key=lambda each: (each[0], each[1] or ""))
    for row, (_, text) in zip(found, texts):
        ids = [*library(text), 1]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    stored = token_files.read_tokens(spark, path)
    assert stored.where("doc_id = 5").first().ids == [*library(ODD[5]), 1]
    token_files.write_tokens(rows.limit(0), path + "-empty")
    assert token_files.read_tokens(spark, path + "-empty").count() == 0


def test_files_hold_stripes_with_bloom_filters(spark, tmp_path):
    from pyarrow import orc

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    token_files.write_tokens(rows, str(tmp_path / "t"))
    file = next((tmp_path / "t").glob("*.orc"))
    assert orc.ORCFile(file).nstripes >= 1
    plan = token_files.read_tokens(spark, str(tmp_path / "t")).where("doc_id = 7").select("n_tokens")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in text and "ids" not in text.split("ReadSchema")[1]


def test_edits_match_fresh_encodings():
    random = np.random.default_rng(3)
    encoder = LibraryEncoder(PATH)
    text = " ".join("".join(random.choice(list("abcdefgh' \n"), 7)) for _ in range(900))
    document = token_counts.CountedText.build(encoder, text)
    for step in range(300):
        at, length = int(random.integers(-5, len(text) + 20)), int(random.integers(0, 60))
        insert = "".join(random.choice(list("xyz's \n"), int(random.integers(0, 40))))
        if step % 50 == 0:
            insert = "grown " * 3000
        document.edit(at, length, insert)
        at = min(max(0, at), len(text))
        text = text[:at] + insert + text[at + length :]
        assert "".join(document.leaves) == text
        assert document.total == len(encoder.encode(split_words(text))) // 4, step
        assert document.widths[1] == len(text)


def test_edits_of_documents(spark):
    rows = documents(spark, [*ODD, ODD[3]]).withColumn("extra", F.lit("x"))
    edits = spark.createDataFrame(
        [(3, 1, 0, 2, "new "), (3, 2, 10, 5, ""), (8, 1, 9000, 10, "\n"), (0, 1, 5, 5, "from null")],
        "doc_id long, seq int, at int, length int, insert string",
    )
    found = token_counts.apply_edits(token_counts.with_edits(token_counts.count_trees(rows), edits)).collect()
    assert len(found) == len(ODD) + 1
    for row in found:
        assert row.tokens_after == len(library(row.text))
        if row.doc_id not in (0, 3, 8):
            assert row.tokens_before == row.tokens_after and row.encoded_chars == 0
    assert next(row.text for row in found if row.doc_id == 0) == "from null"
    assert token_counts.revised_counts(rows.limit(0)).count() == 0


def test_a_worker_keeps_no_words_after_a_task():
    """Words remembered by tasks of one stage took the memory of the stages after it."""
    path = tokenizer_path(prefix_bpe.TOKENIZER_FILE)
    batch = pa.RecordBatch.from_pydict({"text": ["words of a task", "and more of them"]})
    held = []

    def run(encoder, batches):
        for each in batches:
            yield prefix_bpe._ids(encoder, each.column(0).to_pylist())
            held.append(len(encoder.chunks.young))

    first, again = (list(prefix_bpe._encoding(run, path)(iter([batch]))) for _ in range(2))
    encoder = prefix_bpe.trie_encoder(path)
    assert held[0] > 0 and not (encoder.chunks.young or encoder.chunks.old or encoder.pieces.young or encoder.pieces.old)
    assert first[0].equals(again[0])
