import random

import numpy as np
import pytest

from prumo.llm import ngram_join as J


def brute(rows, k, num, den):
    words = {}
    for doc, text in rows:
        ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        words[doc] = {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else {tuple(ws)} if ws else set()
    root = {d: d for d in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(words)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            both = len(words[a] & words[b])
            if both and both * den >= num * (len(words[a]) + len(words[b]) - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted((d, len(words[d]), find(d)) for d in docs)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = [rng.choice(vocabulary) for _ in range(14)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 9, 15, 30, 60, 200]))] for _ in range(12)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "A b"), (4, "a B"), (5, "a b c")]
    for d in range(6, n):
        if rng.random() < 0.3:  # a line that many share beside a few words of its own
            words = [rng.choice(vocabulary) for _ in range(rng.randint(2, 12))] + line
        else:
            words = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                i = rng.randrange(len(words))
                words[i : i + rng.randint(0, 1)] = [rng.choice(vocabulary)] * rng.randint(0, 1)
        rows.append((d, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,block,k,num,den", [(1, 1000, 4, 85, 100), (2, 12, 4, 85, 100), (4, 30, 2, 1, 2)])
def test_equals_brute_force(spark, seed, block, k, num, den):
    rows = corpus(seed, 260)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in J.jaccard_join(docs, k, num, den, block=block).collect())
    assert got == brute(rows, k, num, den)


def test_edges_of_the_input(spark):
    schema = "doc_id long, text string, n string, root int"
    assert J.jaccard_join(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, "a b c d e f", "x", 1), (None, None, None, None), (7, "a b c d e f", "y", 2), (7, "a b c d e f", "y", 2), (3, "A B C D E F", None, None)]
    got = sorted((tuple(r) for r in J.jaccard_join(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == [(3, 2, 3), (7, 2, 3), (7, 2, 3), (None, 0, None), (None, 2, None)]
    kept = J.keep_one(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["3", "None", "None"] and len(kept[0]) == 4


def test_prefix_tree_finds_all_links_that_matter():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2000, 80).astype(np.uint64)
    sets = [np.unique(np.r_[base[rng.random(80) > 0.05 * (i % 4)], rng.integers(0, 2000, i % 7).astype(np.uint64)]) for i in range(60)]
    links = J.link_sets(sets, 4, 5)
    for i, j in links:
        both = len(np.intersect1d(sets[i], sets[j]))
        assert 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both)
    rows = [(d, " ".join(str(x) for x in s)) for d, s in enumerate(sets)]
    root = list(range(60))
    for _ in range(60):
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    assert [(d, len(s), root[d]) for d, s in enumerate(sets)] == brute(rows, 1, 4, 5)


@pytest.mark.parametrize("local", [1 << 20, 0])
def test_components(spark, local):
    from prumo.llm.graph import components, packed

    rng = np.random.default_rng(9)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(packed(spark.createDataFrame(edges, "a long, b long").repartition(7)), local_edges=local).collect()
    assert sorted((r.node, r.root) for r in got) == sorted((x, r) for x, r in root.items() if x != r)
    assert components(packed(spark.createDataFrame([], "a long, b long")), local_edges=local).collect() == []
