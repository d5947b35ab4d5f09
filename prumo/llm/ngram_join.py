"""N-gram Jaccard join: candidates by set segments, links by prefix trees over globally ordered n-gram sets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from prumo.llm.common import U64, ask, chunks, discard, fresh, frugal, hash_words, materialize, mix64, pack, slices, text_buckets, unpack, windows
from prumo.llm.graph import components, local_forest, packed, to_blob

#: Widths of the size classes that share a number of segments.
RATIO = 1.4
#: Signatures that a task gathers before it sends them on.
FLUSH = 1 << 20
#: Bytes of text that travel as one chunk.
CHUNK = 2 << 20
#: Sets that one prefix tree holds at most; larger candidate groups are cut into such blocks.
BLOCK = 1000
#: Sets of a large candidate group that every block holds, so that blocks can join through them.
HUBS = 24


class PrefixTree:
    """Sets as ascending arrays of n-gram numbers in a compressed trie; paths that sets share are stored and compared once.

    link() joins a new set with all sets at or over the threshold that are not in its component yet. At a node, the
    overlap so far plus what can still match, min(n-grams of the query beyond the node, longest set below minus depth),
    bounds the overlap of the whole subtree; under what the shortest set below would need, the subtree is left out.
    """

    __slots__ = ("den", "kids", "label", "least", "most", "num", "own", "owner", "parent", "sizes")

    def __init__(self, num: int, den: int, count: int, sizes: np.ndarray):
        self.num, self.den, self.parent, self.sizes = num, den, list(range(count)), sizes
        self.label: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.kids: list[dict[int, int]] = [{}]
        self.own: list[list[int]] = [[]]
        self.least, self.most = [1 << 60], [0]
        self.owner: list[int] = [-1]  # a set of the subtree if all of its sets are in one component, else -1

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def _node(self, label: np.ndarray, kids: dict[int, int], own: list[int], least: int, most: int, owner: int) -> int:
        for part, value in zip((self.label, self.kids, self.own, self.least, self.most, self.owner), (label, kids, own, least, most, owner), strict=True):
            part.append(value)
        return len(self.label) - 1

    def add(self, idx: int, items: np.ndarray) -> None:
        n, at, pos = len(items), 0, 0
        while True:
            self._hold(at, idx, n)
            if pos == n:
                self.own[at].append(idx)
                return
            kid = self.kids[at].get(int(items[pos]))
            if kid is None:
                self.kids[at][int(items[pos])] = self._node(items[pos:], {}, [idx], n, n, idx)
                return
            label = self.label[kid]
            m = min(len(label), n - pos)
            differ = label[:m] != items[pos : pos + m]
            same = int(differ.argmax()) if differ.any() else m
            if same < len(label):  # split the edge
                lower = self._node(label[same:], self.kids[kid], self.own[kid], self.least[kid], self.most[kid], self.owner[kid])
                self.label[kid], self.kids[kid], self.own[kid] = label[:same], {int(label[same]): lower}, []
            at, pos = kid, pos + same

    def _hold(self, at: int, idx: int, n: int) -> None:
        self.least[at], self.most[at] = min(self.least[at], n), max(self.most[at], n)
        if self.own[at] or self.kids[at]:
            if self.owner[at] >= 0 and self.find(self.owner[at]) != self.find(idx):
                self.owner[at] = -1
        else:
            self.owner[at] = idx

    def link(self, idx: int, items: np.ndarray, member: np.ndarray) -> list[int]:
        """Joins set idx with sets in the tree; returns those linked. member: scratch flags for n-gram numbers, all false."""
        member[items] = True
        n, num, both = len(items), self.num, self.num + self.den
        found: list[int] = []
        stack = [(0, 0, 0)]
        while stack:
            at, overlap, depth = stack.pop()
            if self.owner[at] >= 0 and self.find(self.owner[at]) == self.find(idx):
                continue
            for other in self.own[at]:
                if overlap * both >= num * (n + int(self.sizes[other])) and (p := self.find(other)) != (q := self.find(idx)):
                    self.parent[max(p, q)] = min(p, q)
                    found.append(other)
            for kid in self.kids[at].values():
                label = self.label[kid]
                now, deep = overlap + int(np.count_nonzero(member[label])), depth + len(label)
                rest = n - int(np.searchsorted(items, label[-1], "right"))
                if (now + min(rest, self.most[kid] - deep)) * both >= num * (n + self.least[kid]):
                    stack.append((kid, now, deep))
        member[items] = False
        return found


def link_sets(sets: list[np.ndarray], num: int, den: int, queries: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between sets of hashes that make the same components as all links. queries: flags of the sets that are
    compared with the others (all by default); sets that aren't queries are then taken as compared among themselves."""
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    values, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    cuts = np.split(ranks, np.cumsum(sizes)[:-1])
    tree, member, links = PrefixTree(num, den, len(sets), sizes), np.zeros(len(values), bool), []
    order = np.argsort(sizes, kind="stable")
    if queries is not None:
        order = np.concatenate([order[~queries[order]], order[queries[order]]])
    for i in order.tolist():
        if queries is None or queries[i]:
            links += [(i, j) for j in tree.link(i, cuts[i], member)]
        tree.add(i, cuts[i])
    return links


def shingle_sets(batch: pa.RecordBatch, k: int):
    """Per text its sorted distinct k-word shingle hashes; a shorter text counts as one shingle, one without words as none."""
    words = hash_words(batch.column("text"), lower=True)
    grams = windows(words.hashes, k)
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            yield windows(words.hashes[a:b], b - a) ^ U64(b - a)
        else:
            yield np.zeros(0, U64)


def segment_plan(size: int, num: int, den: int) -> list[tuple[int, int, int]]:
    """(class, segments, spare) for each class a set of this size emits signatures in.

    A pair with sizes a <= b and similarity num/den at least differs in at most (a + b)(den - num)/(den + num) n-grams.
    The pair meets in the class of b. With so many segments of the hash range, plus one, plus `spare`, more than `spare`
    segments are equal, so that an equal segment that isn't empty exists unless both sets have more than `spare` empty ones.
    """
    out = []
    low, high = int(math.log(size) / math.log(RATIO)), int(math.log(max(size, size * den // num)) / math.log(RATIO) + 1e-9)
    for c in range(max(0, low - 1), high + 2):
        first, last = math.ceil(RATIO**c), math.ceil(RATIO ** (c + 1)) - 1  # larger sizes of the pairs in this class
        if first <= last and last >= size and first * num <= size * den:
            differ = 2 * last * (den - num) // (den + num)
            spare = 0 if differ == 0 else 1 + differ // 32
            out.append((c, differ + 1 + spare, spare))
    return out


def signatures(items: np.ndarray, num: int, den: int) -> np.ndarray:
    """One hash for each non-empty segment of the set, in each of its classes; for empty ones only past the spare number."""
    out = []
    for c, m, spare in segment_plan(len(items), num, den):
        part = ((items >> U64(32)) * U64(m)) >> U64(32)
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        salt = U64((c + 1) * 0x632BE59BD9B4E019 % (1 << 64))
        out.append(mix64(np.add.reduceat(mix64(items), cuts) + (part[cuts] + U64(1)) * salt))
        if m - len(cuts) > spare:
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), part[cuts])
            out.append(mix64((empty + U64(1)) * salt ))
    return np.concatenate(out)


_SCAN = "bucket int, doc_id long, n long, p1 long, p2 long, blob binary"


def _rows(bucket, doc, n=None, p1=None, p2=None, blob=None) -> pa.RecordBatch:
    size = len(doc)
    col = lambda v, t: pa.nulls(size, t) if v is None else pa.array(v, t)
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(doc, pa.int64()), col(n, pa.int64()), col(p1, pa.int64()), col(p2, pa.int64()), col(blob, pa.binary())], ["bucket", "doc_id", "n", "p1", "p2", "blob"])


def _packed(docs: list[int], parts: list[np.ndarray], n_buckets: int):
    """Rows for the signatures of some documents: edges between those that share one here (bucket -2), and per bucket a
    blob of five-byte signatures and document numbers, with one document for all that share a signature here."""
    if not docs:
        return
    doc = np.repeat(np.array(docs, np.int64), [len(p) for p in parts])
    sig = np.concatenate(parts)
    order = np.argsort(sig, kind="stable")
    sig, doc = sig[order], doc[order]
    new, nodes, roots = _shared(sig, doc)
    if len(nodes):
        yield _rows([-2], [None], blob=[to_blob(nodes, roots)])
    sig, doc = sig[new], doc[new]
    home, rest = ((sig >> U64(32)) * U64(n_buckets)) >> U64(32), sig & U64((1 << 40) - 1)
    by_doc = np.lexsort((doc, home))
    home, rest, doc = home[by_doc], rest[by_doc], doc[by_doc]
    cuts = np.r_[np.flatnonzero(np.r_[True, home[1:] != home[:-1]]), len(home)].tolist()
    blobs = [np.int64(b - a).tobytes() + (rest[a:b] & U64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (rest[a:b] >> U64(32)).astype(np.uint8).tobytes() + doc[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
    yield _rows(home[cuts[:-1]].astype(np.int32), [None] * len(blobs), blob=blobs)


def _shared(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ascending signatures: flags of the first of equals, and a forest over the documents that share one."""
    new = np.r_[True, sig[1:] != sig[:-1]]
    if new.all():
        return new, np.zeros(0, np.int64), np.zeros(0, np.int64)
    lead = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    return new, *local_forest(doc[~new], lead[~new])


def _scan(k: int, num: int, den: int, n_buckets: int):
    """Rows of facts (bucket -1) for every document, and of packed segment signatures."""

    def run(batches):
        seen: set[tuple[int, int]] = set()
        docs: list[int] = []
        parts: list[np.ndarray] = []
        total = 0
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, n, p1, p2 = batch.column("doc_id").to_pylist(), [], [], []
                for doc, items in zip(ids, shingle_sets(batch, k), strict=True):
                    a, b = (int(v.sum(dtype=U64).astype(np.int64)) if len(v) else 0 for v in (mix64(items), mix64(items ^ U64(0x5851F42D4C957F2D))))
                    n.append(len(items))
                    p1.append(a)
                    p2.append(b)
                    if doc is not None and len(items) and (a, b) not in seen:
                        if len(seen) < 1_000_000:
                            seen.add((a, b))
                        docs.append(doc)
                        parts.append(signatures(items, num, den))
                        total += len(parts[-1])
                        if total >= FLUSH:
                            yield from _packed(docs, parts, n_buckets)
                            docs, parts, total = [], [], 0
                yield _rows(np.full(len(ids), -1), ids, n, p1, p2)
        yield from _packed(docs, parts, n_buckets)

    return run


def _pack_chunks(batches):
    task, number = TaskContext.get().partitionId(), 0
    for part in chunks(batches, "text", CHUNK):
        yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + number]), pa.array([pack(part)], pa.binary())], ["chunk", "body"])
        number += 1


def _count_asks(k: int, n_buckets: int):
    """Each chunk's distinct n-grams (five bytes beside the bucket; those that look alike count as one everywhere) with the
    number of its documents that have them, 255 standing for more."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                values, count = np.unique(np.concatenate([*(s for p in slices(unpack(row["body"]), "text") for s in shingle_sets(p, k))]), return_counts=True)
                parts = ask(values, n_buckets)
                counts = np.split(np.minimum(count, 255).astype(np.uint8), np.cumsum([len(v) for _, v in parts])[:-1])
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in parts], pa.int32()), pa.array([row["chunk"]] * len(parts), pa.int64()), pa.array([len(v) for _, v in parts], pa.int32()), pa.array([(v & U64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (v >> U64(32)).astype(np.uint8).tobytes() + c.tobytes() for (_, v), c in zip(parts, counts, strict=True)], pa.binary())], ["bucket", "chunk", "n", "blob"])

    return run


def _count_replies(table: pa.Table) -> pa.Table:
    """For each chunk's n-grams of this bucket, in how many documents they are: twice the binary logarithm, in a byte."""
    sizes, blobs = table.column("n").to_pylist(), table.column("blob").to_pylist()
    values = [np.frombuffer(b, np.uint32, n).astype(U64) | np.frombuffer(b, np.uint8, n, 4 * n).astype(U64) << U64(32) for b, n in zip(blobs, sizes, strict=True)]
    _, which = np.unique(np.concatenate(values), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate([np.frombuffer(b, np.uint8, n, 5 * n) for b, n in zip(blobs, sizes, strict=True)]))
    level = np.minimum(2 * np.log2(total), 255).astype(np.uint8)[which]
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "levels": pa.array([v.tobytes() for v in np.split(level, np.cumsum(sizes)[:-1])], pa.binary())})


def _prefixes(k: int, num: int, den: int, n_buckets: int):
    """Signatures from prefixes: of a set in the order (frequency, hash) of its n-grams, the first size - ceil(size * num /
    den) + 1; linked sets share one of these."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                part = unpack(row["body"])
                sets = [s for p in slices(part, "text") for s in shingle_sets(p, k)]
                values = np.unique(np.concatenate(sets))
                level = np.concatenate([np.frombuffer(a["levels"], np.uint8) for a in sorted(row["answers"], key=lambda a: a["bucket"])])
                firsts = []
                for items in sets:
                    order = np.argsort(level[np.searchsorted(values, items)], kind="stable")
                    firsts.append(mix64(items[order[: len(items) + (-len(items) * num) // den + 1]]))
                yield from _packed(part.column("doc_id").to_pylist(), firsts, n_buckets)

    return run


def _meet(table: pa.Table) -> pa.Table:
    """Edges between documents that share a signature of this bucket."""
    rest, docs = [], []
    for blob in table.column("blob").to_pylist():
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        rest.append(np.frombuffer(blob, np.uint32, n, 8).astype(U64) | np.frombuffer(blob, np.uint8, n, 8 + 4 * n).astype(U64) << U64(32))
        docs.append(np.frombuffer(blob[8 + 5 * n :], np.int64, n))
    sig, doc = np.concatenate(rest), np.concatenate(docs)
    order = np.argsort(sig, kind="stable")
    _, a, b = _shared(sig[order], doc[order])
    return pa.table({"blob": pa.array([to_blob(a, b)] if len(a) else [], pa.binary())})


def _verify(k: int, num: int, den: int):
    """Links within each (cand, block) of the table, found by a prefix tree."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("cand", "ascending"), ("block", "ascending"), ("doc_id", "ascending")])
        ids, cand, block, query = (table.column(c).to_numpy() for c in ("doc_id", "cand", "block", "query"))
        out: list[tuple[int, int]] = []
        sets: list[np.ndarray] = []
        begin = 0

        def close(end: int) -> None:
            nonlocal sets, begin
            own = query[begin:end].astype(bool)
            out.extend((int(ids[begin + i]), int(ids[begin + j])) for i, j in link_sets(sets, num, den, None if own.all() else own))
            sets, begin = [], end

        at = 0
        for batch in table.to_batches():
            for part in slices(batch, "text"):
                for items in shingle_sets(part, k):
                    if at > begin and (cand[at] != cand[begin] or block[at] != block[begin]):
                        close(at)
                    sets.append(items)
                    at += 1
        close(at)
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return pa.table({"blob": pa.array([to_blob(a, b)] if out else [], pa.binary())})

    return run


def jaccard_join(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text and any others): documents whose sets of k-word
    shingles have a Jaccard similarity of num/den or more are linked, and component_id is the smallest doc_id reachable.

    1. One scan gives each document its set's size and 128-bit fingerprint, and packed segment signatures: the n-grams in
       their global (hash) order are cut into as many segments as a linked pair can differ in, plus one, so that a linked
       pair shares a whole segment. Copies seen before in the task send none; documents of a task that share a signature
       send it once.
    2. Signatures meet in hash buckets; sharing one makes candidates, and components of these make candidate groups.
    3. The texts of candidate groups with several distinct sets move once. Groups over `block` sets, which form around
       lines and passages that many documents share, are made anew from prefixes of the sets with rare n-grams first.
       A prefix tree per group finds the links. Groups still over `block` sets are cut into blocks that all hold HUBS of
       the group's sets; what is then outside the group's largest component is compared, in blocks, with every block, so
       nothing is left out.
    4. Components of all links, with equal sets taken together.
    Words are lower-cased (A-Z) and split at ASCII white space. A text with fewer than k words is one shingle; without
    words (null, empty) the set is empty and linked with nothing. A null doc_id gives a null component_id. doc_id is a key;
    rows that repeat one are each returned, and their texts count as linked. A very long text is one set like others. An empty
    table gives no rows. Links themselves are not returned: a prefix tree leaves out sets that are in the query's component
    already, so each component is spanned, and what is exact is which documents are connected.
    N-grams are told apart by 64-bit hashes (two of n distinct ones are taken for one in about n**2 / 2**65 cases, which changes
    an intersection by one), equal sets by 128 bits.
    """
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_buckets = text_buckets(table)
    scan = materialize(table.mapInArrow(frugal(_scan(k, num, den, n_buckets)), _SCAN), "signatures")
    facts = scan.filter("bucket = -1").select("doc_id", "n", "p1", "p2")
    leads = facts.filter("n > 0 and doc_id is not null").groupBy("n", "p1", "p2").agg(F.min("doc_id").alias("lead"))
    known = materialize(facts.join(leads, ["n", "p1", "p2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("lead", "doc_id").alias("lead")), "facts")
    same = packed(known.filter("doc_id <> lead").select(F.col("doc_id").alias("a"), F.col("lead").alias("b")))
    cands = _groups(components(_edges(scan).union(same)), known)
    discard(scan)
    texts = materialize(table.join(_sized(cands).hint("shuffle_hash"), "doc_id"), "texts")
    wide = texts.filter(F.col("n") > block)
    full = ["doc_id", "text", "cand", "block", "query"]

    def verify(rows: DataFrame) -> DataFrame:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("cand", "block"), F.lit(4 * n_buckets)))
        return materialize(dealt.groupBy("part").applyInArrow(_verify(k, num, den), "blob binary"), "links")

    rows = texts.filter(F.col("n") <= block).withColumn("block", F.lit(0).cast("long")).withColumn("query", F.lit(True)).select(*full)
    large = None
    if not wide.isEmpty():
        members = _narrow(wide, k, num, den, n_buckets)
        placed = members.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("long"))
        large = placed.filter("blocks > 1")
        again = placed.select("doc_id", "cand", "block").union(_hubs(large)).distinct().withColumn("query", F.lit(True))
        rows = rows.union(wide.select("doc_id", "text").join(again, "doc_id").select(*full))
    links = verify(rows)
    if large is not None and not large.isEmpty():
        links = _settle(links, large, lambda asked: verify(wide.select("doc_id", "text").join(asked, "doc_id").select(*full)), block)
    roots = components(links.union(same)).withColumnRenamed("node", "doc_id")
    return known.join(roots, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def _edges(scan: DataFrame) -> DataFrame:
    """Packed edges from rows of packed signatures."""
    met = scan.filter("bucket >= 0").select("bucket", "blob").groupBy("bucket").applyInArrow(_meet, "blob binary")
    return met.union(scan.filter("bucket = -2").select("blob"))


def _groups(roots: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, cand: the candidate group of each document that speaks for its equals."""
    every = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    own = known.filter("doc_id = lead").select(F.col("doc_id").alias("node")).distinct()
    return materialize(every.join(own, "node", "left_semi").select(F.col("node").alias("doc_id"), F.col("root").alias("cand")), "groups")


def _sized(cands: DataFrame) -> DataFrame:
    """doc_id, cand, n for groups of two and more."""
    return cands.join(cands.groupBy("cand").agg(F.count("*").alias("n")).filter("n > 1"), "cand").select("doc_id", "cand", "n")


def _narrow(wide: DataFrame, k: int, num: int, den: int, n_buckets: int) -> DataFrame:
    """Groups again, for documents whose groups are large because they share lines or passages that many have: candidates
    must now share a prefix in the order of rising document frequency, so that common n-grams come last."""
    held = materialize(wide.select("doc_id", "text").mapInArrow(frugal(_pack_chunks), "chunk long, body binary"), "wide")
    asks = held.mapInArrow(frugal(_count_asks(k, n_buckets)), "bucket int, chunk long, n int, blob binary")
    answers = asks.groupBy("bucket").applyInArrow(_count_replies, "chunk long, bucket int, levels binary").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "levels")).alias("answers"))
    scan = materialize(held.join(answers, "chunk").select("body", "answers").mapInArrow(frugal(_prefixes(k, num, den, n_buckets)), _SCAN), "prefixes")
    roots = components(_edges(scan))
    every = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    return _sized(every.select(F.col("node").alias("doc_id"), F.col("root").alias("cand")))


def _hubs(large: DataFrame) -> DataFrame:
    """HUBS documents of each large group, once for each of its blocks; they are the first by hash in block 0, whose size
    is bounded, so that no window holds a whole group."""
    first = large.filter("block = 0").withColumn("_r", F.row_number().over(W.partitionBy("cand").orderBy(F.xxhash64("doc_id")))).filter(F.col("_r") <= HUBS)
    return first.select("doc_id", "cand", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"))


def _settle(links: DataFrame, large: DataFrame, verify, block: int) -> DataFrame:
    """Adds the links between documents outside the largest component of their large group and all of the group."""
    roots = components(links).withColumnRenamed("node", "doc_id")
    state = large.join(roots, "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    count = state.groupBy("cand", "root").agg(F.count("*").alias("m"))
    main = count.groupBy("cand").agg(F.max_by("root", F.struct("m", F.col("root"))).alias("main"))
    apart = materialize(state.join(main, "cand").filter("root <> main").select("doc_id", "cand", "blocks"), "apart")
    if apart.isEmpty():
        return links
    sizes = apart.groupBy("cand").agg(F.ceil(F.count("*") / block).cast("int").alias("chunks"))
    asked = apart.join(sizes, "cand").withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(7)), "chunks"))
    at = lambda b, c: (F.col(b).cast("long") * (1 << 31) + F.col(c).cast("long")).alias("block")
    queries = asked.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("doc_id", "cand", at("b", "chunk"), F.lit(True).alias("query"))
    targets = large.join(sizes, "cand").withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("doc_id", "cand", at("block", "c"), F.lit(False).alias("query"))
    return links.union(verify(queries.union(targets).groupBy("doc_id", "cand", "block").agg(F.max("query").alias("query"))))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of docs that come first (smallest doc_id) in their component, with all their columns.

    Texts without words, null ones among them, and rows with a null doc_id stay. Rows that repeat the smallest doc_id of a
    component all stay. An empty table gives no rows.
    """
    stays = jaccard_join(docs, k, num, den).filter("doc_id = component_id").select("doc_id").distinct()
    own = fresh(docs, "_stays")
    first = docs.join(stays.withColumnRenamed("doc_id", own), F.col("doc_id") == F.col(own), "left_semi")
    return first.union(docs.filter("doc_id is null"))


def digest(docs: DataFrame) -> DataFrame:
    return jaccard_join(docs, 4, 85, 100)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS s FROM w),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
grams AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sized UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, min(r.y) AS component_id FROM sized s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.n
"""
