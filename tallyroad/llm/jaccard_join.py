"""Exact n-gram Jaccard join by a token-group matrix.

A document's set is its distinct word shingles, as 64-bit hashes. A fixed-size sketch of
how many documents hold a hash orders hashes from rare to common; two sets that are similar
enough share several of their first (rarest) hashes, more of them the larger they are. Sets
with enough shared hashes are partitioned into groups of similar sets, and the matrix holds the shared hashes of each
group. A query set meets only groups that hold enough of its own first hashes; where it meets
one, its overlap with the group's whole token union bounds its overlap with every member,
and only groups whose bound reaches the threshold are opened and compared member by member.
Groups are split into blocks of BLOCK members and the queries of a block into shares of
QUERIES, so that no task holds more. Links make components, and no link between different
components is lost, but sets that are connected already are not compared again: first every
set meets its own block and its group's first one; after that only hashes that several
components hold are looked up, and only sets of the smaller of two components meet the
blocks of the larger one. So a large group of near copies meets one block a set, not all of its own. Equal
sets are collapsed before.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroad.llm import common
from tallyroad.llm.components import connected_components

BLOCK, QUERIES = 256, 256
#: One set in so many hashes is asked for beyond the first shared one.
LEVEL = 20
SKETCH_BITS, SLICES = 22, 64
_LOWER = bytes.maketrans(common.UPPER.encode(), common.LOWER.encode())
_KEPT_WORDS = 500_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


class Shingler:
    """Whole texts to their distinct shingle hashes, sorted; a text with fewer words than ``width`` is one shingle."""

    def __init__(self, width: int):
        self.width, self.words = width, _WordHashes()
        rng = np.random.default_rng(11)
        self.factors = rng.integers(1 << 62, 1 << 63, width, np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: bytes | None) -> np.ndarray:
        found = (text or b"").translate(_LOWER).split()  # bytes.split() cuts at 20 and 09-0D, nothing else
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.words) > _KEPT_WORDS:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, found), np.uint64, len(found))
        with np.errstate(over="ignore"):
            width = min(self.width, len(h))
            n = len(h) - width + 1
            total = np.full(n, np.uint64(width if width < self.width else 0), np.uint64)
            for k in range(width):
                total += h[k : k + n] * self.factors[k]
            return np.unique(_mix(total))


def _sketch(width: int):
    """Count documents by sketch cell; one compressed row for each slice of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, counts = Shingler(width), np.zeros(1 << SKETCH_BITS, np.uint32)
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(shingle(text))
                size += len(held[-1])
                if size > 1_000_000:
                    counts += np.bincount((np.concatenate(held) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
                    held, size = [], 0
        if held:
            counts += np.bincount((np.concatenate(held) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)).astype(np.uint32)
        if counts.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "counts": pa.array([zlib.compress(x.tobytes(), 1) for x in np.split(counts, SLICES)], pa.binary())})

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.uint64)
            total[k] = total[k] + part if k in total else part
    for k, counts in total.items():
        capped = np.minimum(counts, np.uint64(0xFFFFFFFF)).astype(np.uint32)  # beyond that all are common
        yield pa.RecordBatch.from_pydict({"slice": pa.array([k], pa.int32()), "counts": pa.array([zlib.compress(capped.tobytes(), 1)], pa.binary())})


def rarity_classes(texts: DataFrame, width: int) -> np.ndarray:
    """Class of each sketch cell: 0 within noise, else the logarithm of what it holds beyond the median. Fixed size."""
    parts = texts.mapInArrow(_sketch(width), "slice int, counts binary").repartition(min(SLICES, common.shuffle_partitions(texts.sparkSession)), "slice").mapInArrow(_add, "slice int, counts binary")
    each = (1 << SKETCH_BITS) // SLICES
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in parts.toLocalIterator():  # SLICES rows of compressed counts
        counts[r["slice"] * each : (r["slice"] + 1) * each] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    usual = float(np.median(counts))
    # no more classes than a count has bits
    steps = np.concatenate([[usual + 4 * np.sqrt(usual) + 2], usual + 2.0 ** np.arange(1, 32)])
    steps = np.unique(steps[steps >= steps[0]])
    classes = np.empty(len(counts), np.uint8)
    for low in range(0, len(counts), each):
        classes[low : low + each] = np.searchsorted(steps, counts[low : low + each])
    return classes


def least_overlap(n: int, num: int, den: int) -> int:
    """Hashes that a set of n shares at least with any set that is similar enough."""
    return -(-num * n // den)


def level(n: int) -> int:
    """First hashes that sets of n or more must share, taking ``level`` more of them than for a single one."""
    return 1 + n // LEVEL


def _ordered(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Hashes from rare to common; the hash itself breaks ties."""
    return hashes[np.argsort(classes[hashes >> np.uint64(64 - SKETCH_BITS)], kind="stable")]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array((np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)).view(np.int64)))


def _prefixes(shared, width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, classes = Shingler(width), shared.value
        for batch in batches:
            sizes, keys, firsts = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingle(text)
                sizes.append(len(hashes))
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                firsts.append(_ordered(hashes, classes)[: len(hashes) - least_overlap(len(hashes), num, den) + level(len(hashes))] if len(hashes) else hashes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(firsts)], names=["doc_id", "n", "key", "prefix"])

    return run


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token: pass on those whose token an adjacent row has too."""
    last_token, last_rep, last_shared = None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens, reps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if last_token is not None:
            tokens, reps = np.concatenate([[last_token], tokens]), np.concatenate([[last_rep], reps])
        same = tokens[1:] == tokens[:-1]
        keep = np.concatenate([[last_shared], same]) | np.concatenate([same, [False]])
        last_token, last_rep, last_shared = tokens[-1], reps[-1], bool(same[-1]) if len(same) else False
        yield pa.RecordBatch.from_arrays([pa.array(tokens[:-1][keep[:-1]]), pa.array(reps[:-1][keep[:-1]])], names=["token", "rep"])
    if last_shared:
        yield pa.RecordBatch.from_arrays([pa.array([last_token], pa.int64()), pa.array([last_rep], pa.int64())], names=["token", "rep"])


def _sets(shared, width: int):
    """Candidate texts to their hashes, rare ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, classes = Shingler(width), shared.value
        for batch in batches:
            low, texts = 0, batch.column(1).to_pylist()
            while low < len(texts):
                arrays, size = [], 0
                while low + len(arrays) < len(texts) and (not arrays or size < 1_000_000):
                    arrays.append(_ordered(shingle(texts[low + len(arrays)]), classes))
                    size += len(arrays[-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(arrays)), batch.column(2).slice(low, len(arrays)), _lists(arrays)], names=["rep", "own", "tokens"])
                low += len(arrays)

    return run


class _Block:
    """At most BLOCK member sets with their token union; finds links among them and to query sets.

    Members whose component is known are not compared with each other, nor a query with members of its own component.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.reps: list[int] = []
        self.sets: list[np.ndarray] = []
        self.known: list[int | None] = []
        self.parent: list[int] = []
        self.heads: dict[int, int] = {}
        self.firsts: dict[int, list[int]] = {}
        self.union: np.ndarray | None = None

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def prefix(self, tokens: np.ndarray) -> list[int]:
        return tokens[: len(tokens) - least_overlap(len(tokens), self.num, self.den) + 1].tolist()

    def links(self, tokens: np.ndarray, mine: int | None, known: int | None) -> list[int]:
        """Members linked to a set, one of each component at most; joins them with member ``mine`` if given."""
        n, found = len(tokens), []
        candidates = {j for t in self.prefix(tokens) for j in self.firsts.get(t, ())}
        candidates = [j for j in candidates if self.den * min(n, len(self.sets[j])) >= self.num * max(n, len(self.sets[j])) and (known is None or self.known[j] != known)]
        sorted_tokens = np.sort(tokens)
        joined: set[int] = set()
        for j in sorted(candidates):
            root = self.find(j)
            if root in joined:
                continue
            other = self.sets[j]
            at = np.searchsorted(sorted_tokens, other)
            at[at == n] = n - 1
            overlap = int((sorted_tokens[at] == other).sum())
            if self.den * overlap >= self.num * (n + len(other) - overlap):
                found.append(j)
                if mine is None:
                    joined.add(root)
                else:
                    self.parent[max(root, self.find(mine))] = min(root, self.find(mine))
                    joined = {self.find(mine)}
        return found

    def add_member(self, rep: int, tokens: np.ndarray, known: int | None) -> list[tuple[int, int]]:
        at = len(self.reps)
        self.reps.append(rep)
        self.sets.append(tokens)
        self.known.append(known)
        self.parent.append(at if known is None else self.heads.setdefault(known, at))
        out = [(self.reps[j], rep) for j in self.links(tokens, at, None)] if known is None else []
        for t in self.prefix(tokens):
            self.firsts.setdefault(t, []).append(at)
        self.union = None
        return out

    def query(self, rep: int, tokens: np.ndarray, known: int | None) -> list[tuple[int, int]]:
        """Open the block only if the overlap with its token union can reach the threshold."""
        if self.union is None:
            self.union = np.unique(np.concatenate(self.sets)) if self.sets else np.zeros(0, np.int64)
        if not len(self.union):
            return []
        at = np.searchsorted(self.union, tokens)
        at[at == len(self.union)] = 0
        if int((self.union[at] == tokens).sum()) < least_overlap(len(tokens), self.num, self.den):
            return []
        return [(self.reps[j], rep) for j in self.links(tokens, None, known)]


def _open(num: int, den: int):
    """Rows sorted by block, members before queries -> links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for batch in batches:
            out: list[tuple[int, int]] = []
            lists = batch.column("tokens")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for k, (b, role, rep, known) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "role", "rep", "known")), strict=True)):
                if b != at:
                    at, block = b, _Block(num, den)
                tokens = flat[offsets[k] : offsets[k + 1]].copy()
                out += block.add_member(rep, tokens, known) if role == 0 else block.query(rep, tokens, known)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return run


class _Opener:
    """Opens blocks: sends the sets of members and queries to them and returns the links they find."""

    def __init__(self, base: DataFrame, shared, width: int, num: int, den: int):
        self.base, self.shared, self.width, self.num, self.den = base, shared, width, num, den

    def __call__(self, members: DataFrame, queries: DataFrame, inside: bool) -> DataFrame:
        """Links (a, b). ``members`` and ``queries``: rep, block, known (component so far or null); ``inside``: blocks without queries are opened for their members, too."""
        n = common.shuffle_partitions(self.base.sparkSession)
        sizes = members.groupBy("block").agg(F.count(F.lit(1)).alias("members")).join(queries.groupBy("block").agg(F.count(F.lit(1)).alias("queries")), "block", "left")
        enough = (F.col("members") > 1) | (F.col("queries") > 0) if inside else F.col("queries") > 0
        busy = common.materialize(sizes.where(enough).select("block", F.greatest(F.ceil(F.coalesce("queries", F.lit(0)) / QUERIES), F.lit(1)).cast("int").alias("shares")), "busy")
        # a block's members go with every share of its queries
        asked = members.join(busy, "block").select("rep", "known", "block", F.lit(0).alias("role"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
        asked = asked.unionAll(queries.join(busy, "block").select("rep", "known", "block", F.lit(1).alias("role"), F.pmod(F.xxhash64("rep"), F.col("shares")).cast("int").alias("share")))
        asked = asked.groupBy("rep").agg(F.collect_set(F.struct(F.xxhash64("block", "share").alias("block"), "role", "known")).alias("own"))
        texts = self.base.join(asked, self.base["doc_id"] == asked["rep"]).select("rep", "text", F.to_json("own").alias("own"))
        opened = texts.mapInArrow(_sets(self.shared, self.width), "rep long, own string, tokens array<long>")
        rows = opened.select(F.explode(F.from_json("own", "array<struct<block:bigint,role:int,known:bigint>>")).alias("o"), "rep", "tokens").select("o.block", "o.role", "o.known", "rep", "tokens")
        return rows.repartition(n, "block").sortWithinPartitions("block", "role", "rep").mapInArrow(_open(self.num, self.den), "a long, b long")


def jaccard_components(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Component of every document under links of Jaccard similarity num / den or more on ``width``-word shingles.

    ``docs`` needs doc_id and text. Words are runs free of white space with A-Z lower-cased; a text with
    fewer words than ``width`` is one shingle, a null, empty or blank text has none and links with nothing.
    Returns doc_id, n_shingles and component_id (the smallest doc_id reachable, itself included). Rows that
    repeat a doc_id are one node; a null doc_id is no node and has a null component; an empty table gives an
    empty table.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    classes = spark.sparkContext.broadcast(rarity_classes(base.select("text"), width))
    sets = common.materialize(base.mapInArrow(_prefixes(classes, width, num, den), "doc_id long, n long, key binary, prefix array<long>"), "sets")
    distinct = common.materialize(sets.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix")).where("rep is not null"), "distinct")
    n = common.shuffle_partitions(spark)
    tokens = distinct.select(F.explode("prefix").alias("token"), "rep").repartition(n, "token").sortWithinPartitions("token")
    firsts = common.materialize(tokens.mapInArrow(_shared_only, "token long, rep long"), "firsts")
    # groups: sets that have their most frequent first hash in common, so that few blocks hold it; blocks of a bounded size
    # a partner has num / den of the hashes at least, so both share as many first hashes as its level
    need = (1 + F.floor(F.ceil(F.col("n") * num / den) / LEVEL)).alias("need")
    needs = distinct.groupBy("rep").agg(F.min("n").alias("n")).select("rep", need)
    frequent = firsts.join(firsts.groupBy("token").agg(F.count(F.lit(1)).alias("holders")), "token")
    groups = frequent.groupBy("rep").agg(F.max(F.struct("holders", F.xxhash64("token").alias("grp")))["grp"].alias("grp"), F.count(F.lit(1)).alias("shared")).join(needs, "rep").where("shared >= need").select("rep", "grp", "need")
    groups = common.materialize(groups, "groups")
    sizes = groups.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    number = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    blocks = common.materialize(groups.join(sizes, "grp").select("rep", "need", F.xxhash64("grp", number).alias("own"), F.xxhash64("grp", F.lit(0).cast("bigint")).alias("first")), "blocks")
    opener = _Opener(base, classes, width, num, den)
    unknown = F.lit(None).cast("long").alias("known")
    near = opener(blocks.select("rep", F.col("own").alias("block"), unknown), blocks.where("own <> first").select("rep", F.col("first").alias("block"), unknown), True)
    begun = common.materialize(connected_components(near), "begun")
    # what is left: hashes of several components, and blocks that hold another component as large as the set's own or larger
    known = blocks.join(begun, blocks["rep"] == begun["node"], "left").select("rep", "need", "own", "first", F.coalesce("component", "rep").alias("known"))
    known = begun_by = common.materialize(known, "known")
    known = common.materialize(known.join(known.groupBy("known").agg(F.count(F.lit(1)).alias("size")), "known"), "known-sizes")
    common.discard(begun_by)
    placed = every = common.materialize(firsts.join(known, "rep"), "placed")
    mixed = placed.groupBy("token").agg(F.min("known").alias("low"), F.max("known").alias("high")).where("low < high").select("token")
    placed = common.materialize(placed.join(mixed, "token", "left_semi"), "placed-mixed")
    common.discard(every)
    # the two largest components of a block's sets with a hash, of at most BLOCK
    tops = F.slice(F.sort_array(F.collect_set(F.struct("size", "known")), False), 1, 2)
    matrix = placed.groupBy("token", F.col("own").alias("block")).agg(tops.alias("tops")).select("token", "block", *[F.get("tops", F.lit(k))[c].alias(f"{c}_{k}") for k in (0, 1) for c in ("size", "known")])
    # of two components the smaller one's sets ask, of equal ones those of the smaller block; a set is a member of its own block
    other = "if(known_0 = known, size_1, size_0)"
    met = placed.join(matrix, "token").where(f"own <> block and block <> first and ({other} > size or {other} = size and own < block)").groupBy("rep", "block", "need", "known").agg(F.count(F.lit(1)).alias("hits")).where("hits >= need")
    met = common.materialize(met.select("rep", "block", "known"), "met")
    common.discard(placed, firsts)
    far = opener(known.select("rep", F.col("own").alias("block"), "known"), met, False)
    components = common.materialize(connected_components(begun.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(far)), "components")
    nodes = common.materialize(distinct.join(components, distinct["rep"] == components["node"], "left").select("key", F.coalesce("component", "rep").alias("component")), "nodes")
    return sets.drop("prefix").join(nodes, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents that stay: of each component the smallest doc_id, with all columns."""
    found = jaccard_components(docs, width, num, den)
    return common.keep_ids(docs, found.where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))))


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(common.read(spark, sf_dir, "documents"), 3, 90, 100)


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+2], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.seen),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id
"""
