"""Operators 5, 6 and 7 against plain versions."""

import hashlib
import random

import numpy as np
import pytest

from docweave.llm import common, jaccard, substrings, vectors

from . import brute
from .fixtures import DATA, frame, rows, unique


@pytest.fixture(autouse=True)
def shipped(spark):
    common.ship(spark)


@pytest.mark.parametrize("group", [4000, 2, 0])
def test_substrings_match_brute_force(spark, group):
    table = rows()
    want = brute.dedup(unique(table))
    got = substrings.digests(frame(spark, table), group).collect()
    assert len(got) == len(table)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]
    lone = [r for r in got if r.doc_id is None]
    assert sorted(r.n_removed for r in lone) == [0, 0]


def test_substrings_on_the_driver_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = brute.dedup([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digests(docs).collect()}
    assert got == want


def test_remove_repeats_keeps_columns_and_drops_what_is_left_empty(spark):
    table = rows()
    want = brute.dedup(unique(table))
    out = substrings.remove_repeats(frame(spark, table))
    assert out.columns == frame(spark, table).columns
    got = out.collect()
    for r in got:
        if r.doc_id is not None:
            kept = " ".join(brute.words(r.text))
            assert hashlib.sha256(kept.encode()).hexdigest() == want[r.doc_id][2]
    ids = {r.doc_id for r in got}
    assert ids == {i for i, (n, cut, _) in want.items() if n == 0 or cut < n} | {None}


def test_remove_repeats_keeps_columns_of_any_name(spark):
    line = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, line, 7, "l", "r"), (2, f"a b {line}", 8, "m", "s"), (3, line, 9, "n", "t")], "doc_id long, text string, _id int, lo string, row string")
    out = substrings.remove_repeats(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, line, 7, "l", "r"), (2, "a b ", 8, "m", "s")]


def test_groups_count_windows(spark):
    """One long run of a periodic text is large, many short ones are not."""
    runs = spark.createDataFrame([(1, 300), (2, 13), (2, 13), (3, 1), (4, 1), (4, 1), (4, 1)], "anchor long, size int")
    assert {r.anchor: r.large for r in substrings._groups(runs, 2).collect()} == {1: True, 2: False, 4: True}


@pytest.mark.parametrize("group", [4000, 0])
def test_two_texts_under_one_id(spark, group):
    """A cut text shares its id with a shorter clean one, a short copy, a null and an empty one."""
    line = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    passage, cut, clean = line("p", 30), f"{line('h', 40)} {line('p', 30)} end", line("c", 25)
    same, other = f"{line('q', 24)} x", f"{line('q', 24)} y z"  # at the same places under one id
    table = [(0, "a b"), (1, passage), (2, cut), (2, clean), (2, "a b"), (2, None), (2, ""), (3, same), (3, other)]
    df = frame(spark, [(i, t, None, None, None, k, "c", "t") for k, (i, t) in enumerate(table)])
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.digests(df, group).collect())
    late = [r for r in got if r[0] == 3]
    assert [r for r in got if r[0] < 3] == [(0, 2, 0), (1, 30, 0), (2, 0, 0), (2, 0, 0), (2, 2, 0), (2, 25, 0), (2, 71, 30)]
    assert sorted(r[2] for r in late) == [0, 24]
    kept = sorted((r.doc_id, r.text or "") for r in substrings.remove_repeats(df, group).collect())
    left = f"{line('h', 40)} end"
    assert [x for x in kept if x[0] < 3] == sorted([(0, "a b"), (1, passage), (2, left), (2, clean), (2, "a b"), (2, ""), (2, "")])
    assert sorted(x[1] for x in kept if x[0] == 3) in (sorted([same, "y z"]), sorted(["x", other]))


@pytest.mark.parametrize(("region", "block"), [(1 << 22, 1024), (300, 2), (0, 3)])
def test_jaccard_matches_brute_force(spark, region, block):
    table = rows()
    want = brute.similar(unique(table))
    got = jaccard.similar(frame(spark, table), region, block).collect()
    assert len(got) == len(table)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        else:
            assert r.component_id is None


def test_jaccard_on_the_driver_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = brute.similar([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(docs).collect()} == want


def stock_rows(n, paragraphs=24, taken=8, seed=7):
    """Documents put together from a few stock paragraphs: nearly all pairs share some."""
    rng = random.Random(seed)
    stock = [" ".join(f"p{k}w{i}" for i in range(30)) for k in range(paragraphs)]
    return [(i, "\n".join(stock[k] for k in rng.sample(range(paragraphs), taken)), None, None, None, 0, "c", "t") for i in range(n)]


@pytest.mark.parametrize("region", [1 << 22, 3000])
def test_jaccard_on_recombined_boilerplate(spark, region):
    table = stock_rows(150, 12, 8)
    want = brute.similar(unique(table))
    assert len({c for _, c in want.values()}) < 140
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(frame(spark, table), region, 40).collect()} == want


def test_jaccard_keeps_texts_under_one_id_apart(spark):
    """Id 5 stands on two texts, each near another document; all are reachable through it only if its texts were one."""
    line = lambda c, n=60: [f"{c}{i}" for i in range(n)]
    text = lambda w, k: " ".join(w[:k] + ["edit"] + w[k + 1 :])
    a, b = line("a"), line("b")
    table = [(1, " ".join(a)), (2, " ".join(b)), (5, text(a, 59)), (5, text(b, 59)), (7, text(b, 0))]
    got = jaccard.similar(frame(spark, [(i, t, None, None, None, 0, "c", "t") for i, t in table])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2), (5, 1), (5, 2), (7, 2)]


def test_keep_first_leaves_one_of_each_group(spark):
    line = lambda c, n=60: [f"{c}{i}" for i in range(n)]
    a, b = line("a"), line("b")
    near = [*a[:30], "edit", *a[31:]]
    table = [(3, a), (3, a), (5, near), (5, b), (7, b), (8, line("c")), (9, []), (9, []), (None, a)]
    df = spark.createDataFrame([(i, " ".join(w), "x", 1, "r") for i, w in table], "doc_id long, text string, first string, n int, row string").repartition(3)
    out = jaccard.keep_first(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id or 0), r.text.split()) for r in out.collect())
    assert got == sorted([(3, a), (5, b), (8, line("c")), (9, []), (0, a)])
    assert jaccard.keep_first(df.where("false")).collect() == []


def test_long_words_that_a_polynomial_confuses_differ(spark):
    word = "a"
    swap = str.maketrans("ab", "ba")
    for _ in range(11):
        word += word.translate(swap)
    texts = [" ".join([word] * 30), " ".join([word.translate(swap)] * 30)]
    df = frame(spark, [(i, t, None, None, None, 0, "c", "t") for i, t in enumerate(texts)])
    assert sorted((r.doc_id, r.component_id) for r in jaccard.similar(df).collect()) == [(0, 0), (1, 1)]
    assert sorted((r.doc_id, r.n_removed) for r in substrings.digests(df).collect()) == [(0, 29), (1, 29)]


@pytest.mark.parametrize("per_task", [1 << 20, 3])
def test_components_of_any_number_of_edges(spark, per_task):
    rng = random.Random(3)
    edges = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(i, i + 1) for i in range(200, 230)] + [(300, i) for i in range(301, 330)]
    want = brute.components({x for e in edges for x in e if e[0] != e[1]}, edges)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.component for r in common.components(df, per_task).collect() if r.id in want} == want
    assert common.components(df.where("false")).count() == 0


def test_region_links_connect_what_is_linked():
    rng = np.random.default_rng(5)
    for _ in range(30):
        base = np.unique(rng.integers(0, 1 << 60, 40).astype(np.uint64))
        sets = []
        for _ in range(20):
            keep = base[rng.random(len(base)) > 0.12]
            sets.append(np.unique(np.r_[keep, rng.integers(0, 1 << 60, rng.integers(0, 5)).astype(np.uint64)]))
        ids = list(range(len(sets)))
        links = [(i, j) for i in ids for j in ids if i < j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
        found = jaccard.region_links(ids, sets)
        assert brute.components(ids, found) == brute.components(ids, links)


def edited(rng, size, most, n):
    """n sets of one text of so many words, each with up to so many words of its own."""
    base, out = rng.integers(0, 1 << 60, size), []
    for _ in range(n):
        words = base.copy()
        words[rng.integers(0, size, rng.integers(0, most))] = rng.integers(0, 1 << 60)
        out.append(np.unique(np.lib.stride_tricks.sliding_window_view(words, 5).astype(np.uint64) @ np.array([3, 5, 7, 11, 13], dtype=np.uint64)))
    return out


def test_region_links_compare_a_document_with_the_region_once(monkeypatch):
    """Copies whose edits leave many of them linked to no other, or to a few only, in a region of many balls."""
    rng = np.random.default_rng(11)
    sets = edited(rng, 120, 9, 400)
    links = [(i, j) for i in range(400) for j in range(i) if 100 * (s := len(np.intersect1d(sets[i], sets[j], assume_unique=True))) >= 75 * (len(sets[i]) + len(sets[j]) - s)]
    want = brute.components(range(400), links)
    assert 40 < len(set(want.values())) < 300
    asked, shared = [], jaccard._Sets.shared
    monkeypatch.setattr(jaccard._Sets, "shared", lambda self, own: asked.append(own.tobytes()) or shared(self, own))
    assert brute.components(range(400), jaccard.region_links(list(range(400)), sets)) == want
    assert len(asked) <= 400


def test_shared_counts_of_common_and_rare_values():
    rng = np.random.default_rng(12)
    sets = [*edited(rng, 150, 12, 200), *edited(rng, 20, 3, 5), np.arange(3, dtype=np.uint64)]
    index = jaccard._Sets(sets)
    assert len(index.bits) > 1 and len(index.owner)
    for own in [sets[0], sets[7], sets[202], sets[205], np.unique(np.r_[sets[3][:40], sets[201], [np.uint64(1), np.uint64((1 << 64) - 1)]]), sets[0][:0]]:
        assert index.shared(own).tolist() == [len(np.intersect1d(own, s)) for s in sets]


@pytest.mark.parametrize(("i", "j"), [(0, 0), (0, 1)])
def test_block_pairs_are_those_of_different_groups_within_the_bounds(i, j):
    rng = np.random.default_rng(13)
    sets = [*edited(rng, 70, 5, 30), *edited(rng, 68, 5, 30), *edited(rng, 66, 5, 30), np.unique(np.r_[0:70]).astype(np.uint64)]  # 16 and 32 classes
    n, classes = np.array([len(s) for s in sets]), [jaccard._classes(s) for s in sets]
    assert len({len(c) for c in classes}) == 2
    node, pos, part, own = rng.permutation(len(sets)), rng.integers(0, 9, len(sets)), np.minimum(rng.integers(0, 12, len(sets)), 4), rng.integers(i, j + 1, len(sets))
    want = set()
    for a in range(len(sets)):
        for b in range(a):
            p, q = (np.frombuffer(classes[k], dtype=np.uint8).astype(int).reshape(16, -1).sum(axis=1) for k in (a, b))
            if len(classes[a]) == len(classes[b]):
                p, q = (np.frombuffer(classes[k], dtype=np.uint8).astype(int) for k in (a, b))
            able = part[a] != part[b] and {own[a], own[b]} == {i, j} and 4 * n[a] >= 3 * n[b] and 4 * n[b] >= 3 * n[a] and 7 * min(n[a] - pos[a], n[b] - pos[b]) >= 3 * (n[a] + n[b])
            if able and (max(p.max(), q.max()) >= 255 or 7 * abs(p - q).sum() <= n[a] + n[b]):
                want.add((min(node[a], node[b]), max(node[a], node[b])))
    found = jaccard.block_pairs(node, n, pos, part, own, i, j, classes)
    assert want and len(found) == len(want) and set(found) == want


def test_a_group_with_half_of_a_region_takes_in_the_small_ones(spark):
    """Region 1: group 100 has 12 of 18, two documents alone go to it, group 200 is too large. Region 2 is not dense, region 3 has no such group."""
    rows = [(1, 18, k, 100) for k in range(12)] + [(1, 18, k, k) for k in (50, 51)] + [(1, 18, k, 200) for k in range(60, 64)]
    rows += [(2, 4, k, 100) for k in range(3)] + [(2, 4, 52, 52)]
    rows += [(3, 16, k, k) for k in range(70, 86)]
    mixed = spark.createDataFrame([(h, node, 30, 0, part, c) for h, c, node, part in rows], "h long, node long, n long, pos int, part long, c long")
    groups = spark.createDataFrame([(k, 100) for k in range(12)] + [(k, 200) for k in range(60, 64)], "id long, component long")
    moved = jaccard._taken_in(mixed, groups)
    assert sorted(tuple(r) for r in moved.collect()) == [(50, 100), (51, 100)]
    left = jaccard._renamed(mixed.where("part <> 200"), moved)
    assert sorted({(r.h, r.c) for r in left.collect()}) == [(2, 4), (3, 16)]
    assert {r.part for r in jaccard._renamed(mixed, moved).where("h = 1").collect()} == {100, 200}


def test_jaccard_on_a_cluster_with_copies_linked_to_none(spark):
    rng = random.Random(14)
    base, table = [f"b{i}" for i in range(100)], []
    for k in range(120):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 3, 4, 4, 5])):
            w[rng.randrange(100)] = f"x{rng.randrange(10**6)}"
        table.append((k, " ".join(w), None, None, None, 0, "c", "t"))
    want = brute.similar(unique(table))
    assert 1 < len({c for _, c in want.values()}) < 110
    for region in (1 << 22, 2000):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar(frame(spark, table), region, 30).collect()} == want


def test_empty_tables(spark):
    docs = frame(spark, []).where("false")
    assert substrings.digests(docs).collect() == []
    assert substrings.remove_repeats(docs).collect() == []
    assert jaccard.similar(docs).collect() == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near(empty).collect() == []


def plain_links(table, threshold):
    """{vec_id: (n_links, component_id)}; repeated ids are one vector."""
    able = {}
    for i, v, label in table:
        if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            able[i] = (label, np.array(v, dtype=np.float64))
    ids, links = sorted(able), []
    for a in ids:
        for b in ids:
            if a < b and able[a][0] == able[b][0] and len(able[a][1]) == len(able[b][1]):
                x, y = able[a][1], able[b][1]
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links.append((a, b))
    part = brute.components(ids, links)
    count = {i: sum(i in p for p in links) for i in ids}
    return {i: (count.get(i, 0), part.get(i, i)) for i, _, _ in table if i is not None}, links


@pytest.mark.parametrize("block", [1000, 3])
def test_vectors_make_no_false_link_and_find_nearly_all(spark, block):
    rng = np.random.default_rng(2)
    table = []
    for c in range(30):
        centre = rng.standard_normal(64)
        for _ in range(6):
            table.append((len(table), (centre + 0.18 * rng.standard_normal(64)).astype(np.float32).tolist(), c % 4))
    table += [(1000, table[0][1], 0), (1001, table[0][1], 0), (1002, table[0][1], None), (1003, None, 1), (1004, [0.0] * 64, 1), (1005, [float("nan")] * 64, 1), (1006, [1.0, None], 1), (1007, [], 1), (1008, [1.0, 2.0], 1), (1009, [2.0, 4.0], 1), (None, table[0][1], 0)]
    table.append(table[3])
    df = spark.createDataFrame([(*r, "x", 1) for r in table], "vec_id long, embedding array<float>, label int, unit string, id int").repartition(3)
    got = vectors.near(df, block=block).collect()
    assert len(got) == len(table)
    want, links = plain_links(table, 0.93)
    found = 0
    for r in got:
        assert r.kept == (r.vec_id is not None and r.vec_id == r.component_id)
        if r.vec_id is not None:
            assert r.n_links <= want[r.vec_id][0]
            found += r.n_links
        else:
            assert r.n_links == 0
    assert found >= 0.95 * 2 * len(links)


def test_vectors_on_the_driver_embeddings(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    want, links = plain_links([(r.vec_id, r.embedding, r.label) for r in df.collect()], 0.93)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near(df).collect()}
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.95 * 2 * len(links)
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


def test_of_regions_with_the_same_members_the_first_is_compared(spark):
    rows = [(h, node, 30, place + node % 2, node) for h, place in ((7, 3), (8, 1), (9, 5)) for node in range(5)]
    rows += [(10, node, 30, 0, node) for node in range(1, 6)]  # other members
    rows += [(11, node, 30, 0, 1) for node in range(6)]  # one group
    rows += [(12, node, 30, 0, node) for node in range(3)]  # compared in full before
    mixed = jaccard._mixed(spark.createDataFrame(rows, "h long, node long, n long, pos int, part long"))
    assert sorted((r.h, r.node, r.c) for r in mixed.collect()) == [(h, k, 5) for h, ks in ((8, range(5)), (10, range(1, 6))) for k in ks]
