import itertools
import random

import cases
import numpy as np
import pytest

from strata.llm import decontam, graph, jaccard


def shingles(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows, t=0.8):
    own = {k: shingles(x) for k, x, *_ in rows}
    label, links = {k: k for k in own}, dict.fromkeys(own, 0)
    near = [(a, b) for a, b in itertools.combinations(own, 2) if own[a] and own[b] and len(own[a] & own[b]) >= t * len(own[a] | own[b]) - 1e-9]
    for a, b in near:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {k: (label[k], links[k]) for k in own}


def corpus():
    r = random.Random(2)
    rows = []
    for base in range(30):
        words = cases.words(base, r.randint(3, 120))
        for _ in range(r.randint(1, 8)):
            copy = list(words)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(["x", "yy", copy[0]])
            rows.append(" ".join(copy))
    r.shuffle(rows)
    return [(i * 3 - 20, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 3])
def test_classes_and_links_against_brute_force(spark, block):
    rows = corpus()
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), jaccard.Params(block=block)).collect()
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in got} == brute(rows)


def test_one_large_group_of_near_copies(spark):
    """A chain of near copies over several blocks: all links counted, none listed."""
    words = cases.words(1, 200)
    rows = [(i, " ".join([*words[: i % 190], f"n{i}", *words[i % 190 + 1 :]])) for i in range(90)] + [(1000 + i, " ".join(words)) for i in range(40)]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), jaccard.Params(block=16)).collect()
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in got} == brute(rows)


@pytest.mark.parametrize("clash", [False, True])
def test_awkward_rows(spark, clash):
    got = jaccard.classes(cases.documents(spark, clash)).collect()
    assert len(got) == len(cases.rows())
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["class_id"], by[2]["class_id"], by[1]["links"], by[1]["copies"]) == (-7, -7, 2, 1)
    for key in (3, 4, 5):
        assert (by[key]["class_id"], by[key]["links"], by[key]["shingles"]) == (key, 0, 0)
    assert by[7]["class_id"] == by[8]["class_id"] == 7
    assert by[None]["class_id"] is None
    assert jaccard.classes(cases.nothing(spark)).collect() == []


def test_prefix_reaches_the_recall():
    p = jaccard.Params()
    assert 1 - (1 - 0.8**p.prefix) ** p.trees >= p.recall > 1 - (1 - 0.8 ** (p.prefix + 1)) ** p.trees
    assert jaccard.Params(recall=0.5).prefix > p.prefix


def test_intersections():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 200, n).astype(np.uint64)) for n in r.integers(1, 90, 60)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    assert (jaccard.intersections(sets) == want).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7), (500, 3), (-4, 200)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100, 500: 1, -4: -4, 200: -4}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# -- decontamination ---------------------------------------------------------------------------

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.randrange(6) for _ in range(r.randint(1, 80))] for _ in range(2))
        assert decontam.common_subsequence(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)) == lcs(a, b)


def planted():
    items = [(i, cases.prose(900 + i, 15 + 4 * i)) for i in range(10)] + [(50, None), (51, ""), (52, "!!"), (53, "two words"), (54, cases.prose(905, 35))]
    rows, want = [], set()
    for i in range(10):
        words = items[i][1].split()
        rows.append((10 * i, cases.prose(i, 70) + " " + items[i][1].upper() + ", " + cases.prose(i + 40, 50)))
        changed = [w if (k + i) % 6 else "other" for k, w in enumerate(words)]  # a paraphrase
        rows.append((10 * i + 1, cases.prose(i + 80, 33) + " " + " ".join(changed)))
        rows.append((10 * i + 2, cases.prose(i + 120, 120)))
        rows.append((10 * i + 3, cases.prose(i + 160, 40) + " " + " ".join(words[: len(words) // 3])))
        want |= {(10 * i, i), (10 * i + 1, i)}
    rows += [(200, items[3][1]), (201, "some two words here"), (None, items[4][1]), (202, None), (203, ""), (204, items[3][1]), (204, items[3][1])]
    want |= {(200, 3), (201, 53), (None, 4), (204, 3)}
    same = {(d, 54) for d, i in want if i == 5}
    return items, rows, want | same


def test_passages_and_paraphrases_are_found_and_clean_documents_left_alone(spark):
    items, rows, want = planted()
    assert items[5][1] == items[-1][1]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS key", "2 AS id", "3 AS cosine")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontam.search(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) + 1  # 204 is there twice
    blocks = decontam.search(docs, bench, decontam.Params(block_items=4)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in blocks} == want


def test_no_short_item_is_lost_among_many(spark):
    words = np.random.default_rng(4).permutation([f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"])
    r = random.Random(8)
    items = [(i, " ".join(r.choices(words.tolist(), k=4 + 2 * (i % 3)))) for i in range(450)]
    rows = [(i, " ".join([*r.choices(words.tolist(), k=40), text, *r.choices(words.tolist(), k=40)])) for i, text in items]
    got = decontam.search(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(i, i) for i, _ in items} <= {(x["doc_id"], x["item_id"]) for x in got}


def test_a_full_block_has_every_items_own_row(spark):
    """Cosines of items in the latent space are those of their own rows, whatever the size of a block."""
    p, r = decontam.Params(), random.Random(5)
    texts = [" ".join(f"w{r.randrange(3000)}" for _ in range(4)) for _ in range(min(p.block_items, 600))]
    block = decontam.Items.build(list(range(len(texts))), texts)
    source = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:50])], "key bigint, text string")
    _, found, _ = decontam.latent_space(source, block, p)
    words = dict(zip(block.vocabulary.tolist(), range(len(block.vocabulary)), strict=True))
    seen = np.zeros(len(words))
    for w in block.words[:50]:
        seen[[words[v] for v in set(w.tolist())]] += 1
    exact = block.matrix(np.log(51 / (1 + seen)) + 0.2)
    assert np.allclose(found @ found.T, exact @ exact.T, atol=1e-3)


def test_empty_sides(spark):
    items, rows, _ = planted()
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert decontam.search(docs, bench.where("item_id < 0")).collect() == []
    assert decontam.search(docs.where("doc_id < 0"), bench).collect() == []


def test_frequencies_and_space(spark):
    """Document frequencies are those of a plain count over the passages."""
    items, rows, _ = planted()
    p = decontam.Params()
    block = decontam.Items.build([1, 2], [items[8][1], items[9][1]])
    texts = [t for _, t in rows if t]
    source = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key bigint, text string")
    weights, found, singular = decontam.latent_space(source, block, p)
    passages = []
    for t in texts:
        h, at, _ = decontam.word_hashes([t.lower()], marks=True)
        n = len(h)
        starts = range(0, max(1, n - p.passage // 2), p.passage // 2) if n > p.passage // 2 else [0]
        passages += [set(h[s : s + p.passage].tolist()) for s in starts if n]
    idf = np.log((1 + len(passages)) / (1 + np.array([sum(v in x for x in passages) for v in block.vocabulary.tolist()]))) + 0.2
    assert np.allclose(np.linalg.norm(weights, axis=1) <= idf + 1e-4, True)
    exact = block.matrix(idf)
    assert np.allclose(found @ found.T, exact @ exact.T, atol=1e-3)


def test_sorted_tries_tie_what_shares_a_prefix(spark):
    """Neighbours in the sorted paths connect exactly the sets that share a prefix of some tree."""
    p = jaccard.Params(trees=6, depth=5, recall=0.97)
    assert 1 < p.prefix < p.depth
    base = [cases.prose(s, 120).split() for s in range(12)]
    texts = [" ".join(w) for w in base] + [" ".join(w[: 10 * k] + ["other"] + w[10 * k + 1 :]) for w in base for k in (1, 5)] + [" ".join(w[:60]) for w in base]
    paths = jaccard.tree_paths(jaccard.shingle_sets(texts, p.words), p)
    rows = [(i, bytearray(x.tobytes())) for i, own in enumerate(paths) for x in own]
    members = spark.createDataFrame(rows, "node bigint, path binary")
    want = {}
    for t in range(p.trees):
        for i, x in enumerate(paths[:, t]):
            want.setdefault((t, x[: 2 + 2 * p.prefix].tobytes()), set()).add(i)

    def classes(edges, n):
        label = list(range(n))
        for _ in range(n):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        ties = [(r.a, r.b, r.depth) for r in jaccard.trie_ties(members, p).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert ties and all(p.prefix <= d <= p.depth for _, _, d in ties) and max(d for _, _, d in ties) > p.prefix
    truth = [(min(g), i) for g in want.values() for i in g]
    assert classes([(a, b) for a, b, _ in ties], len(texts)) == classes(truth, len(texts))
    # one tie less than sets in a node, and no more
    assert len(ties) <= sum(len(g) - 1 for g in want.values())


def test_recall_against_brute_force():
    """Pairs at and above the threshold that meet in the forest, of all such pairs."""
    p = jaccard.Params()
    r = np.random.default_rng(5)
    meet = pairs = 0
    for i in range(150):
        n = 200
        common = r.integers(0, 1 << 63, n, dtype=np.uint64)
        extra = int(round(n * 0.125))  # 200 / 250 = 0.8
        a, b = (np.unique(np.concatenate((common, r.integers(0, 1 << 63, extra, dtype=np.uint64)))) for _ in range(2))
        x = jaccard.tree_paths([a, b], p)
        pairs += 1
        meet += bool((x[0, :, : 2 + 2 * p.prefix] == x[1, :, : 2 + 2 * p.prefix]).all(axis=1).any())
    assert pairs == 150 and meet >= 0.99 * pairs


def test_components_of_chains_stars_and_random_graphs(spark):
    r = random.Random(12)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(900, 960)] + [(2000 + r.randint(0, 80), 2000 + r.randint(0, 80)) for _ in range(70)]
    label = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == label
