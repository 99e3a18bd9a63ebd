"""Jaccard join, vectors, components, license scans and the language model against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrain.llm import components, language_model, license_scan, near_vectors, ngram_join, queries
from lexigrain.llm.elias_fano import EliasFano, NgramTrie
from lexigrain.llm.ngram_join import signatures


def grouped(pairs, nodes):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def shingles(text, size=3):
    words = (text or "").encode().lower().split()
    runs = [words[at:] for at in range(size)]
    return frozenset(zip(*runs)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute_groups(texts, percent=90, size=3):
    sets = {at: shingles(text, size) for at, text in enumerate(texts)}
    pairs = [
        (a, b) for a in sets for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return grouped(pairs, sets)


def edited_family(draw, words, copies, edits):
    """Chains of copies, each some words away from an earlier one."""
    family = [words]
    for _ in range(copies):
        copy = list(draw.choice(family))
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(len(copy))] = f"e{draw.randrange(10**6)}"
        family.append(copy)
    return [" ".join(each) for each in family]


def family_texts(seed=1):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(300)}"
    texts = [None, "", " \n", "one", "ONE", "one two", "one two", "Ä one", "ä one", "x" * 9000]
    passage = " ".join(word() for _ in range(40))
    for size, copies in ((12, 20), (40, 40), (150, 60), (700, 25)):
        texts += edited_family(draw, [word() for _ in range(size)], copies, max(1, size // 40))
    texts += [passage + " " + " ".join(word() for _ in range(draw.randint(0, 60))) for _ in range(60)]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize(("percent", "size"), [(90, 3), (80, 5)])
def test_jaccard_groups_equal_brute_force(spark, percent, size):
    texts = family_texts()
    rows = spark.createDataFrame([(at, text, 7) for at, text in enumerate(texts)], "doc_id long, text string, node int")
    found = {row.doc_id: row for row in ngram_join.similar_groups(rows, percent, size).collect()}
    want = brute_groups(texts, percent, size)
    assert {at: row.component_id for at, row in found.items()} == want
    assert all(found[at].n_shingles == len(shingles(text, size)) for at, text in enumerate(texts))
    kept = ngram_join.one_of_each(rows, percent, size)
    assert kept.columns == rows.columns and {row.doc_id for row in kept.collect()} == {at for at in want if want[at] == at}


@pytest.mark.parametrize("members", [ngram_join.MEMBERS, 7])
def test_jaccard_finds_links_that_leaders_miss(spark, monkeypatch, members):
    """With no links known every node is its own group, so all links must come from the matrix."""
    monkeypatch.setattr(ngram_join, "MEMBERS", members)
    texts = family_texts(2)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = ngram_join.shingled(rows, 3).cache()
    leaders = ngram_join.leader_pairs(rows, 90, 3).cache()
    wanted = nodes.where("node is not null").select("node").distinct()
    texts_of = ngram_join.node_texts(nodes, wanted, rows, 3)
    none = spark.createDataFrame([], "node long, component long")
    links = [(row.a, row.b) for row in ngram_join.links_between_groups(leaders, none, texts_of, 90, 3).collect()]
    node = {row.doc_id: row.node for row in nodes.collect()}
    found = grouped(links, {at for at in node.values() if at is not None})
    want = brute_groups(texts)
    for a in want:
        for b in range(a):
            if node[a] is not None and node[b] is not None:
                assert (found[node[a]] == found[node[b]]) == (want[a] == want[b])


@pytest.mark.parametrize("percent", [90, 80])
def test_similar_sets_share_a_signature(percent):
    draw = random.Random(4)
    for size in (1, 2, 5, 9, 10, 11, 19, 20, 60, 333, 1000):
        for _ in range(30):
            tokens = np.unique(np.array([draw.getrandbits(64) for _ in range(size)], dtype=np.uint64))
            gone, new = 0, 0
            while True:  # as many differences as the threshold allows
                if 100 * (len(tokens) - gone - 1) >= percent * (len(tokens) + new) and draw.random() < 0.5:
                    gone += 1
                elif 100 * (len(tokens) - gone) >= percent * (len(tokens) + new + 1):
                    new += 1
                else:
                    break
            rest = np.delete(tokens, draw.sample(range(len(tokens)), gone))
            other = np.unique(np.concatenate([rest, np.array([draw.getrandbits(64) for _ in range(new)], dtype=np.uint64)]))
            assert np.intersect1d(signatures(tokens, percent), signatures(other, percent)).size


def test_jaccard_repeated_ids_and_empty_table(spark):
    base = " ".join(f"a{k}" for k in range(50))
    rows = spark.createDataFrame([(1, base), (1, base + " end"), (1, base), (2, "other " + base), (3, None)], "doc_id long, text string")
    found = ngram_join.similar_groups(rows).collect()
    assert len(found) == 5 and {(row.doc_id, row.component_id) for row in found} == {(1, 1), (2, 1), (3, 3)}
    assert ngram_join.one_of_each(rows).count() == 2
    assert ngram_join.similar_groups(rows.limit(0)).count() == 0


def test_components(spark):
    draw = random.Random(9)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 600)]
    edges = chain + star + [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(60)] + [(5, 5)]
    frame = spark.createDataFrame(edges, "a long, b long")
    nodes = {node for a, b in edges if a != b for node in (a, b)}
    want = grouped([(a, b) for a, b in edges if a != b], nodes)
    found = components.components(frame).collect()
    assert {row.node: row.component for row in found} == want and len(found) == len(want)
    assert components.components(frame.limit(0)).count() == 0


def test_vectors_equal_brute_force(spark):
    random_ = np.random.default_rng(2)
    base = random_.standard_normal((300, 32))
    near = np.concatenate([base[:60] + random_.standard_normal((60, 32)) * scale for scale in (0.05, 0.1, 0.2, 0.3)])
    hot = base[0] + random_.standard_normal((80, 32)) * 0.05
    vectors = [row.astype(np.float32).tolist() for row in np.concatenate([base, near, hot, base[:5], 3 * base[5:8]])]
    vectors += [None, [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0] * 8, [2.0] * 8, []]
    rows = spark.createDataFrame([(at, each, 1) for at, each in enumerate(vectors)], "vec_id long, embedding array<float>, node int")
    found = {row.vec_id: row for row in near_vectors.near_duplicates(rows).collect()}
    good = {}
    for at, each in enumerate(vectors):
        if each and None not in each and np.isfinite(each).all() and any(each):
            unit = np.array(each, dtype=np.float32).astype(float)
            good[at] = unit / np.linalg.norm(unit)
    pairs = [(a, b) for a in good for b in good if a > b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.95]
    degrees = Counter(node for pair in pairs for node in pair)
    assert len(found) == len(vectors)
    assert all(found[at].n_links <= degrees[at] for at in found)
    assert sum(row.n_links for row in found.values()) >= 0.97 * 2 * len(pairs)
    want = grouped(pairs, range(len(vectors)))
    assert sum(found[at].component_id != want[at] for at in found) <= 2
    assert all(row.kept == (row.vec_id == row.component_id) for row in found.values())
    assert near_vectors.near_duplicates(rows.limit(0)).count() == 0


def test_vectors_of_any_length(spark):
    """Finite components whose squares leave the range of doubles."""
    draw = np.random.default_rng(3)
    base = draw.normal(size=16)
    rows = [(at, (scale * (base + 0.01 * draw.normal(size=16))).tolist()) for at, scale in enumerate([1.0, 1e200, 1e-200, 5e-310, 1e300])]
    rows += [(10, (1e250 * draw.normal(size=16)).tolist()), (11, [0.0] * 16)]
    found = {r.vec_id: r for r in near_vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [(found[at].n_links, found[at].component_id) for at in range(5)] == [(4, 0)] * 5
    assert found[10].n_links == found[11].n_links == 0


def test_vectors_of_a_hot_cell_are_cut_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 20)
    random_ = np.random.default_rng(3)
    vectors = np.ones(16) + random_.standard_normal((150, 16)) * 0.01
    rows = spark.createDataFrame([(at, each.tolist()) for at, each in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = near_vectors.near_duplicates(rows).collect()
    assert {row.n_links for row in found} == {149} and {row.component_id for row in found} == {0}


def test_license_spans(spark):
    mit = license_scan.TEMPLATES["mit-permission"]
    changed = mit.replace("free of charge", "at no cost at all").upper()
    texts = [
        None, "", "nothing to see here", "code; Released under the MIT License. more",
        "intro words " + mit + " outro", "- " + changed + " -", (license_scan.TEMPLATES["gpl-3.0"] + "\n") * 3,
        "filler " * 5000 + license_scan.TEMPLATES["cc-by-nc-4.0"], "all of the and to be",
    ]
    rows = spark.createDataFrame([(at, text, 1) for at, text in enumerate(texts)], "doc_id long, text string, template int")
    found = {}
    for row in license_scan.scan(rows).collect():
        found.setdefault((row.doc_id, row.template), []).append(row)
    assert {key[0] for key in found} == {3, 4, 5, 6, 7}
    assert found[4, "mit-permission"][0].coverage == 1.0
    span = found[4, "mit-permission"][0]
    assert texts[4][span.char_start : span.char_end] == mit
    assert 0.9 < found[5, "mit-permission"][0].coverage < 1.0
    assert len(found[6, "gpl-3.0"]) == 3 and found[7, "cc-by-nc-4.0"][0].matched_words == 5
    assert license_scan.scan(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(rows, {"short": "two words"})


def test_license_scan_misses_no_run_of_five_words():
    draw = random.Random(8)
    index = license_scan.Index.of(license_scan.TEMPLATES)
    for _ in range(200):
        owner = draw.randrange(len(index.words))
        words = index.words[owner]
        at = draw.randrange(0, len(words) - 4)
        text = [draw.getrandbits(62) for _ in range(6)] + words[at : at + 5] + [draw.getrandbits(62) for _ in range(6)]
        hashes = license_scan.grams(np.array(text, dtype=np.int64))
        assert owner in index.hits(hashes[license_scan.winnowed(hashes)])[1]


def test_elias_fano():
    draw = np.random.default_rng(1)
    for size, top in ((0, 10), (1, 1), (5, 10), (1000, 1 << 62), (30_000, 1 << 50), (1000, 5)):
        values = np.sort(draw.integers(0, top, size).astype(np.uint64))
        sequence = EliasFano.build(values)
        asked = np.concatenate([values, draw.integers(0, top, 500).astype(np.uint64), np.array([1 << 63], np.uint64)])
        assert (sequence.values(np.arange(size)) == values).all()
        assert (sequence.successors(asked) == np.searchsorted(values, asked)).all()
    assert NgramTrie.open(NgramTrie.build(*[np.zeros(0, np.uint64)] * 6).buffer()).look_up(np.array([5], np.uint64))[0][0] == -1


def test_trie_in_a_memory_mapped_file(tmp_path):
    words = np.array([1 << 40, 5 << 40, 9 << 40], dtype=np.uint64)
    trie = NgramTrie.build(words, np.array([3, 1, 2]), np.array([-0.5, 0.0, -1.0]), words[[0, 0, 2]] >> np.uint64(32),
                           np.array([7, 4, 7], np.uint64), np.array([1.0, 2.0, 3.0]))
    (tmp_path / "trie").write_bytes(trie.buffer())
    opened = NgramTrie.open(np.memmap(tmp_path / "trie", mode="r"))
    at, counts, backoff = opened.look_up(words)
    assert counts.tolist() == [3, 1, 2] and backoff.tolist() == [-0.5, 0.0, -1.0]
    assert opened.gains_of(at[[0, 0, 1, 2, 2]], np.array([4, 7, 7, 7, 4], np.uint64)).tolist() == [2.0, 1.0, 0.0, 3.0, 0.0]


@pytest.mark.parametrize(("batch_tokens", "least"), [(200, 2), (language_model.BATCH_TOKENS, None)])
def test_language_model_equals_brute_force(spark, monkeypatch, batch_tokens, least):
    monkeypatch.setattr(language_model, "BATCH_TOKENS", batch_tokens)
    draw = random.Random(6)
    texts = [None, "", "Ä ä A a", *(" ".join(draw.choice("a a a b b c d e F f g".split()) for _ in range(draw.randrange(60))) for _ in range(80))]
    rows = [(at, text, 1) for at, text in enumerate(texts)] + [(7, texts[7], 1), (None, "a b", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    found = (language_model.held_out_scores(frame, least) if least else language_model.held_out_scores(frame)).collect()
    assert len(found) == len(rows)
    tokens = lambda text: [0, *(text or "").encode().lower().split(), 1]
    learned = [tokens(text) for at, text, _ in rows if at is None or zlib.crc32(str(at).encode()) % 7 != 2]
    words, contexts, pairs = Counter(), Counter(), Counter()
    for each in learned:
        words.update(each[1:])
        contexts.update(each[:-1])
        pairs.update(zip(each, each[1:]))
    total, distinct = sum(words.values()), len(words)
    kept = {pair: (n - 0.75) / contexts[pair[0]] for pair, n in pairs.items() if n >= (least or 1)}
    left = {v: 1 - sum(p for (a, _), p in kept.items() if a == v) for v in contexts}
    chance = lambda w: (words[w] + 1) / (total + distinct + 1)
    for row in found:
        each = tokens("a b" if row.doc_id is None else texts[row.doc_id])
        assert row.train_tokens == total and row.n_tokens == len(each) - 1
        assert row.n_known == sum(words[w] > 0 for w in each[1:])
        assert row.base_score == pytest.approx(sum(math.log10(chance(w)) for w in each[1:]))
        want = sum(math.log10(kept.get((v, w), 0) + left.get(v, 1) * chance(w)) for v, w in zip(each, each[1:]))
        assert row.score == pytest.approx(want, abs=2e-3 * len(each))
    mass = [sum(kept.get((v, w), 0) + left[v] * chance(w) for w in words) + left[v] / (total + distinct + 1) for v in contexts]
    assert all(each == pytest.approx(1.0) for each in mass)
    assert language_model.held_out_scores(frame.limit(0)).count() == 0


def test_language_model_query_keeps_bigrams_seen_once(spark, monkeypatch):
    """A held-out copy of one training document is scored with that document's own word pairs."""
    draw = random.Random(11)
    texts = [" ".join(draw.choice("a b c d e".split()) for _ in range(20)) for _ in range(30)]
    ids = [at for at in range(200) if zlib.crc32(str(at).encode()) % 7 != 2][: len(texts) + 1]
    copy = next(at for at in range(200) if zlib.crc32(str(at).encode()) % 7 == 2)
    rare = " ".join(f"rare{k}" for k in range(40))
    rows = [*zip(ids, [*texts, rare]), (copy, rare)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda spark, folder, name: frame)
    found = {row.doc_id: row for row in queries.registry()["op10_trie_language_model"](spark, "").collect()}
    tokens = lambda text: [0, *text.encode().split(), 1]
    learned = [tokens(text) for at, text in rows if at != copy]
    words, contexts = Counter(w for each in learned for w in each[1:]), Counter(v for each in learned for v in each[:-1])
    pairs = Counter(pair for each in learned for pair in zip(each, each[1:]))
    left = {v: 0.75 * sum(a == v for a, _ in pairs) / n for v, n in contexts.items()}
    chance = lambda w: (words[w] + 1) / (sum(words.values()) + len(words) + 1)
    for at, text in rows:
        each = tokens(text)
        want = sum(
            math.log10(max(0, pairs[v, w] - 0.75) / contexts[v] + left[v] * chance(w)) for v, w in zip(each, each[1:])
        )
        assert found[at].score == pytest.approx(want, abs=2e-3 * len(each))
    assert found[copy].held_out and found[copy].score > found[copy].base_score + 40


@pytest.mark.parametrize("name", ["mit", "cc-by-nc-4.0", "apache-2.0"])
@pytest.mark.parametrize("item", ["", "\n- item"])
def test_license_scan_finds_every_repetition(spark, name, item):
    notice = license_scan.TEMPLATES[name]
    text = (item + " " + notice) * 100
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = sorted((row.char_start, row.char_end) for row in license_scan.scan(rows).collect() if row.template == name)
    starts = [at for at in range(len(text)) if text.startswith(notice, at)]
    assert found == [(at, at + len(notice)) for at in starts]


@pytest.mark.parametrize("name", ["mit-permission", "apache-2.0-header"])
@pytest.mark.parametrize(("every", "added"), [(15, 6), (20, 8), (12, 1)])
def test_license_scan_follows_many_small_insertions(spark, name, every, added):
    words = license_scan.TEMPLATES[name].split()
    edited = []
    for at, word in enumerate(words):
        edited += [f"new{at}x{k}" for k in range(added)] if at and at % every == 0 and at < len(words) - 10 else []
        edited.append(word)
    text = "some words before " + " ".join(edited) + " and some after"
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (found,) = [row for row in license_scan.scan(rows).collect() if row.template == name]
    assert found.coverage == 1.0 and text[found.char_start : found.char_end] == " ".join(edited)


def test_one_of_each_keeps_every_group_whatever_the_ids(spark):
    text = lambda name: " ".join(f"{name}{k}" for k in range(60))
    rows = [
        (None, text("a"), 1), (None, text("a") + " end", 2), (None, text("b"), 3), (None, text("c"), 4), (None, text("c"), 5),
        (1, text("d"), 6), (1, text("e"), 7), (2, text("b") + " end", 8), (3, text("f"), 9), (3, text("f"), 10),
        (None, "", 11), (None, None, 12), (4, text("g"), 13), (5, text("g") + " end", 14),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key int")
    for each in (frame, frame.repartition(5)):
        kept = ngram_join.one_of_each(each)
        found = sorted(row.key for row in kept.collect())
        assert kept.columns == frame.columns
        assert len(found) == 9 and {4, 6, 7, 8, 11, 12, 13} < set(found)
        assert len({9, 10} & set(found)) == 1
        assert found[0] in (1, 2)
    groups = {(row.doc_id, row.component_id) for row in ngram_join.similar_groups(frame).collect()}
    assert (None, 2) in groups and (2, 2) in groups and (None, None) in groups


def test_vectors_with_null_or_repeated_ids(spark):
    random_ = np.random.default_rng(5)
    base = random_.standard_normal((6, 32))
    near = base + random_.standard_normal((6, 32)) * 0.01
    ids = [None, None, 1, 2, 2, None], [3, None, None, 4, 5, 6]
    rows = [(at, each.tolist()) for side, vectors in zip(ids, (base, near)) for at, each in zip(side, vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = [3, None, 1, 2, 2, 6]
    for each in (frame, frame.coalesce(1)):
        found = near_vectors.near_duplicates(each).collect()
        assert sorted(map(str, ((row.vec_id, row.n_links, row.component_id, row.kept) for row in found))) == sorted(
            str((at, 1, low, at == low)) for side in ids for at, low in zip(side, want)
        )
