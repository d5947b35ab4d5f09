"""Exact, line and substring dedup and mixing on rows that SQL doesn't describe: null and repeated ids, clashing names."""

import random
from collections import Counter, defaultdict

from prumo.llm import exact_dedup, line_dedup, mixing, substring_dedup


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_exact_dedup(spark):
    rows = [(1, "a b"), (2, "ab"), (2, "ab"), (None, "ab"), (None, None), (3, None), (4, ""), (5, "b a")]
    docs = spark.createDataFrame([(*r, "n", 0, "k") for r in rows], "doc_id long, text string, leader string, group int, key string")
    want = [(1, 1, 3, True), (2, 1, 3, False), (2, 1, 3, False), (None, None, 1, True), (None, None, 1, True), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True)]
    assert collected(exact_dedup.dedup(docs), "doc_id", "keep_id", "group_size", "kept") == sorted(want, key=repr)
    assert exact_dedup.dedup(docs.limit(0)).collect() == []


def test_equal_fingerprints_are_compared(spark):
    """Without any fingerprint, texts of one length collide and only the comparison tells them apart."""
    texts = ["ab", "cd", "a b", "ef", "cd", "xy" * 50_000, "xy" * 49_999 + "xz", "xy" * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = collected(exact_dedup.dedup(docs, points=0), "doc_id", "keep_id", "group_size")
    assert got == [(0, 2, 2), (1, 1, 2), (2, 2, 2), (3, 3, 1), (4, 1, 2), (5, 5, 2), (6, 6, 1), (7, 5, 2)]


def test_fingerprints_compose():
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(200_001))
    want = tuple(sum(int.from_bytes((data + b"\0")[i : i + 2], "little") * pow(x, (len(data) - 1 - i) // 2, exact_dedup.PRIME) for i in range(0, len(data), 2)) % exact_dedup.PRIME for x in exact_dedup.POINTS)
    assert exact_dedup.fingerprint(data) == want
    left, right = data[:1000], data[1000:]
    assert exact_dedup.combine(exact_dedup.fingerprint(left), exact_dedup.fingerprint(right), len(right)) == want


def test_line_dedup(spark):
    line = "forty characters and a few more are in here"
    rows = [(k, f"{k}\n {line.upper()} \n{k}") for k in range(5)] + [(None, line), (9, None), (10, ""), (4, "again")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, drops int, hash string")
    want = [(k, f"{k}\n{k}", 3, 1) for k in range(4)] + [(4, f"4\n {line.upper()} \n4", 3, 0), (None, line, 1, 0), (9, "", 1, 0), (10, "", 1, 0), (4, "again", 1, 0)]
    assert collected(line_dedup.dedup_lines(docs), "doc_id", "kept_text", "n_lines", "n_dropped") == sorted(want, key=repr)
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def brute_substrings(rows, length):
    words = [(doc, (text or "").split(" ") if text else []) for doc, text in rows]
    seen = Counter(tuple(w[i : i + length]) for _, w in words for i in range(len(w) - length + 1))
    out = []
    for doc, w in words:
        gone = {p for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for p in range(i, i + length)}
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def test_substring_dedup(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(40)]
    rows = [(None, " ".join(base)), (7, "x"), (7, "x"), (8, None), (9, "")]
    for k in range(80):
        words = [rng.choice("abcdef") for _ in range(rng.randint(0, 40))]
        at, a = rng.randint(0, len(words)), rng.randint(0, 30)
        words[at:at] = base[a : a + rng.randint(0, 15)]
        rows.append((k % 50, " ".join(words)))
    docs = spark.createDataFrame([(*r, 1, "a") for r in rows], "doc_id long, text string, alive int, chunk string").repartition(4)
    for length, chunk in ((9, 1 << 20), (9, 100), (2, 300), (1, 500)):
        got = collected(substring_dedup.dedup_substrings(docs, length, chunk), "doc_id", "n_words", "n_removed", "kept_text")
        assert got == brute_substrings(rows, length), (length, chunk)
    assert substring_dedup.dedup_substrings(docs.limit(0)).collect() == []


def test_mixing_meets_its_targets(spark):
    rng = random.Random(5)
    source = lambda k: "hot" if k % 3 == 0 else rng.choice(["a", "b", None, "d"])
    rows = [(k if k % 11 else None, source(k), rng.choice([None, "", "w " * rng.randint(1, 300)]), k, "s") for k in range(3000)]
    docs = spark.createDataFrame([*rows, *rows[:20]], "doc_id long, source string, text string, size int, _row string").repartition(5)
    plan = mixing.plan(docs.select("doc_id", "source", mixing.words(mixing.F.col("text")).alias("size"))).collect()
    assert len(plan) == 3020
    taken, facts = defaultdict(int), {}
    for r in plan:
        assert 0 <= r.taken <= 3 * r.size and (r.taken == 0 if r.size == 0 else r.taken % r.size == 0)
        taken[r.source] += r.taken
        facts[r.source] = r.target, r.source_size
    for s, (target, size) in facts.items():
        assert target <= 3 * size + 1e-6 and abs(taken[s] - target) <= 300
    assert len(facts) == 5 and abs(sum(t for t, _ in facts.values()) - sum(n for _, n in facts.values())) < 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in plan)
    assert sorted(map(repr, mixed.collect())) == sorted(map(repr, mixing.mix(docs.repartition(2)).collect()))
    assert mixing.mix(docs.limit(0)).collect() == []


def test_exact_dedup_of_one_id_with_several_texts(spark):
    rows = [(1, "aa"), (1, "bb"), (2, "aa"), (3, "b b"), (3, "cc")]
    want = [(1, 1, 2, True), (1, 3, 2, False), (2, 1, 2, False), (3, 3, 2, True), (3, 3, 1, True)]
    got = exact_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collected(got, "doc_id", "keep_id", "group_size", "kept") == sorted(want, key=repr)


def test_line_dedup_counts_documents_not_rows(spark):
    duckdb = __import__("duckdb")
    line = "forty characters and a few more are in here"
    for rows in ([(7, line)] * 5 + [(8, line)], [(7, line)] * 2 + [(k, f"{k}\n{line}\n{line}") for k in range(4)] + [(7, f"x\n{line}")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        con = duckdb.connect()
        con.execute("create table documents (doc_id bigint, text varchar)")
        con.executemany("insert into documents values (?, ?)", rows)
        want = sorted(con.sql(line_dedup.SQL).select("doc_id, n_lines, n_dropped, kept_sha256").fetchall(), key=repr)
        assert collected(line_dedup.digest(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_huge_texts_are_hashed_in_parts(spark, monkeypatch):
    """Texts over the bound, cut into chunks that are hashed apart, get the same rows as in one piece."""
    rng = random.Random(4)
    big = "".join(rng.choice("ab cé\n\x0b日") for _ in range(200_000))
    rows = [(1, big), (2, big.replace(" ", "  ")), (3, big[:-1] + "z"), (4, "a b"), (5, None), (6, " " * 70_000), (2, big.replace(" ", "  ")), (None, big), (7, "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256", "chars")
    want = collected(exact_dedup.dedup(docs, huge=1 << 40), *columns)
    assert collected(exact_dedup.dedup(docs, huge=1), *columns) == want and collected(exact_dedup.dedup(docs, huge=100_000), *columns) == want
    assert {r[0]: r[1] for r in want if r[0]} == {1: 2, 2: 2, 3: 3, 4: 4, 5: 6, 6: 6, 7: 4}
