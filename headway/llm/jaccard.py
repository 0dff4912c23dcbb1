"""N-gram Jaccard join (operator 3): extended prefixes, token combinations for frequent classes, exact verification.

The elements of a document are its word shingles.  Documents with equal sets are one class; only
classes are joined.

1. Extended prefix.  With p(n) = n - ceil(t n) + 1 and k(n) about half of it, two sets of Jaccard
   similarity t or more share at least min(k(x), k(y)) of their p(n) + k(n) - 1 least elements in
   any global order.  The order is that of the hashes, so no corpus-wide ordering has to be known
   beforehand.
2. Rare first.  The frequencies of the prefix elements are counted exactly.  Within the extended
   prefixes, ordered by frequency, at least k elements being shared again means that the first
   few - elements that no other class has come first, and need no index - share one or two.
3. Index.  Rare elements are indexed singly.  Frequent ones (in more than ``rare`` classes) are
   indexed by pairs, for which the prefix is longer by one; sets so small that pairs can't be
   demanded, or so large that they would multiply the entries by more than ``pair_factor``, are
   indexed by single elements there as well.  Which form holds depends on the smaller size of two
   sets, and a set enters every form it may need.
4. Candidates.  Members of an index entry are compared by size and by a parity signature, whose Hamming distance can't exceed the size of the symmetric difference, so no true pair is
   lost.  Large entries are cut into blocks, and block meets block in tasks of their own.  Of the
   pairs that pass, an entry returns a spanning forest only, not all pairs.
5. Verification.  Forest edges are checked on the whole sets.  Entries in which an edge fails return
   their other pairs in a second pass, so that components are exact.

Defined results: null and empty texts have an empty set and are linked with nothing; repeated
rows get a row each; a row with a null id belongs to the component of its text and links others
like any row, and a component without any id has component_id null; texts of any length give their
whole sets; sets exactly at the threshold link, and of equal ids the smallest is the same; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import bounded_batches, discard, id_text, staged, struct_type
from headway.llm.components import components
from headway.llm.shingles import mix, set_id, shingle_sets


@dataclass(frozen=True)
class Tuning:
    """None of these changes the result, only what is compared where."""

    #: Elements in at most so many classes are rare.
    rare: int = 8
    #: Pairs of frequent elements are indexed for sets whose entries they multiply by this at most.
    pair_factor: int = 4
    #: Members of an index entry that are compared in one task at most.
    block: int = 2048
    #: Bits of the parity signature.
    bits: int = 1024


TUNING = Tuning()

SETS = struct_type(doc_id=T.LongType(), text_key=T.LongType(), node=T.LongType(), n=T.IntegerType(), prefix=T.ArrayType(T.LongType()), bits=T.BinaryType())
KEYS = struct_type(node=T.LongType(), key=T.LongType())
EDGES = struct_type(a=T.LongType(), b=T.LongType(), key=T.LongType(), i=T.IntegerType(), j=T.IntegerType())


def least_partner(n: int, percent: int) -> int:
    """ceil(t n): the least size, and the least overlap, of a set that is similar to one of size n."""
    return -(-percent * n // 100)


def prefix_size(n: int, percent: int) -> int:
    """p(n)."""
    return n - least_partner(n, percent) + 1


def shared_size(n: int, percent: int) -> int:
    """k(n)."""
    return (prefix_size(n, percent) + 1) // 2


def extended_size(n: int, percent: int) -> int:
    return min(n, prefix_size(n, percent) + shared_size(n, percent) - 1) if n else 0


def signature(hashes: np.ndarray, bits: int) -> bytes:
    """For each of the bits, whether an odd number of elements falls on it."""
    odd = np.bincount((hashes >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def document_sets(docs: DataFrame, words: int, percent: int, tuning: Tuning = TUNING) -> DataFrame:
    """doc_id, text_key (a hash of the text), node (the id of its set), n (its size), extended prefix and signature."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            least = [s[: extended_size(len(s), percent)] for s in sets]
            flat = np.concatenate([*least, np.empty(0, np.uint64)]).view(np.int64)
            offsets = np.cumsum([0, *map(len, least)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array([signature(s, tuning.bits) for s in sets], pa.binary()),
                ],
                names=SETS.names,
            )

    return id_text(docs).withColumn("text_key", F.xxhash64("text")).mapInArrow(run, SETS)


def pair_sizes(percent: int, factor: int) -> range:
    """Sizes of the smaller of two sets for which frequent elements are indexed by pairs."""
    able = (n for n in range(1, 10_000) if shared_size(n, percent) > 1)  # below, one shared element is all to rely on
    first = next(able)
    # f elements have f (f - 1) / 2 pairs
    fits = (n for n in range(first, 10_000) if prefix_size(n, percent) > 2 * factor)
    return range(first, next(fits))


def index_keys(n: int, hashes: np.ndarray, frequency: np.ndarray, percent: int, tuning: Tuning = TUNING) -> np.ndarray:
    """Index keys of a set, from the elements of its extended prefix that other classes have, too."""
    order = np.lexsort((hashes, frequency))
    hashes, frequency = hashes[order], frequency[order]
    size = extended_size(n, percent)
    alone = size - len(hashes)
    least = least_partner(n, percent)
    shared = shared_size(least, percent)
    paired = pair_sizes(percent, tuning.pair_factor)
    by_pairs = n >= paired.start and least < paired.stop
    singly = least < paired.start or n >= paired.stop
    one = max(0, size - shared + 1 - alone)
    two = max(0, size - max(shared, 2) + 2 - alone)
    reach = max(one if singly else 0, two if by_pairs else 0)
    rare = frequency <= tuning.rare
    keys = [hashes[:reach][rare[:reach]]]
    if singly:
        keys.append(hashes[:one][~rare[:one]])
    if by_pairs:
        often = hashes[:two][~rare[:two]]
        a, b = np.triu_indices(len(often), 1)
        low, high = np.minimum(often[a], often[b]), np.maximum(often[a], often[b])
        keys.append(mix(mix(low) * np.uint64(3) + high))
    return np.concatenate(keys)


def index(classes: DataFrame, percent: int, tuning: Tuning = TUNING) -> DataFrame:
    """Index entries of classes (node, n, prefix, bits) with two members or more: key, block pair (i, j), own block, node, n, bits."""
    elements = classes.select("node", F.explode("prefix").alias("element"))
    frequency = staged(elements.groupBy("element").agg(F.count(F.lit(1)).alias("frequency")).where("frequency > 1"))
    common = elements.join(frequency, "element").groupBy("node").agg(F.collect_list(F.struct("element", "frequency")).alias("common"))
    members = common.join(classes.select("node", "n"), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("common")
            offsets = np.asarray(lists.offsets)
            hashes = np.asarray(lists.values.field("element")).view(np.uint64)
            frequency = np.asarray(lists.values.field("frequency"))
            sizes = batch.column("n").to_pylist()
            keys = [index_keys(n, hashes[a:b], frequency[a:b], percent, tuning) for n, a, b in zip(sizes, offsets, offsets[1:])]
            node = np.repeat(np.asarray(batch.column("node")), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate([*keys, np.empty(0, np.uint64)]).view(np.int64))], names=KEYS.names)

    keys = staged(members.mapInArrow(run, KEYS))
    sizes = staged(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    blocks = F.ceil(F.col("size") / tuning.block).cast("int")
    own = F.when(blocks > 1, F.pmod(F.hash("node"), blocks)).otherwise(0)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    placed = (
        keys.join(sizes, "key")
        .select("key", "node", blocks.alias("blocks"), own.alias("own"))
        .select("key", "node", "own", other)
        .select("key", "node", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    return placed.join(classes.select("node", "n", "bits"), "node").select("key", "i", "j", "own", "node", "n", "bits")


def passing(n: np.ndarray, bits: np.ndarray, own: np.ndarray, across: bool, percent: int) -> np.ndarray:
    """Matrix of the pairs that size and signature allow; ``across``: only between the two blocks."""
    distance = np.zeros((len(n), len(n)), np.uint16)
    for word in bits.T:
        distance += np.bitwise_count(word[:, None] ^ word[None, :])
    # overlap >= t/(1+t) * (x + y), so the symmetric difference is at most (1-t)/(1+t) * (x + y)
    ok = distance <= (n[:, None] + n[None, :]) * (100 - percent) // (100 + percent)
    ok &= 100 * n[:, None] >= percent * n[None, :]
    ok &= 100 * n[None, :] >= percent * n[:, None]
    np.fill_diagonal(ok, False)
    if across:
        ok &= own[:, None] != own[None, :]
    return ok


def forest(ok: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph with this adjacency matrix."""
    new = np.ones(len(ok), bool)
    edges: list[tuple[int, int]] = []
    for root in range(len(ok)):
        if not new[root]:
            continue
        new[root] = False
        todo = [root]
        while todo:
            at = todo.pop()
            found = np.flatnonzero(ok[at] & new)
            new[found] = False
            edges += [(at, int(x)) for x in found]
            todo += found.tolist()
    return edges


def entry_pairs(entries: DataFrame, percent: int, labelled: bool, tuning: Tuning = TUNING) -> DataFrame:
    """Candidate pairs of every index entry: a spanning forest, or (``labelled``) all pairs of different label."""
    columns = ["key", "i", "j", "own", "node", "n", "bits", *(["label"] if labelled else [])]
    spread = entries.select(*columns).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def pairs(group: dict[str, np.ndarray]) -> np.ndarray:
        across = group["i"][0] != group["j"][0]
        ok = passing(group["n"], group["bits"], group["own"], across, percent)
        if labelled:
            ok &= group["label"][:, None] != group["label"][None, :]
            return np.argwhere(np.triu(ok))
        return np.array(forest(ok), np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] | None = None
        names = [c for c in columns if c != "bits"]

        def batch_pairs(data: dict[str, np.ndarray], last: bool) -> tuple[pa.RecordBatch, dict[str, np.ndarray]]:
            """Pairs of all groups that are complete, and the rows of the one that may go on."""
            size = len(data["key"])
            changed = np.ones(size, bool)
            changed[1:] = (data["key"][1:] != data["key"][:-1]) | (data["i"][1:] != data["i"][:-1]) | (data["j"][1:] != data["j"][:-1])
            bounds = np.append(np.flatnonzero(changed), size)
            done = len(bounds) - 1 - (not last)
            two = bounds[:done][np.diff(bounds)[:done] == 2]
            found = []
            if len(two):  # most entries; all of them at once
                n, bits = data["n"], data["bits"]
                distance = np.bitwise_count(bits[two] ^ bits[two + 1]).sum(axis=1, dtype=np.int64)
                x, y = n[two], n[two + 1]
                ok = (100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & (distance <= (x + y) * (100 - percent) // (100 + percent))
                ok &= (data["i"][two] == data["j"][two]) | (data["own"][two] != data["own"][two + 1])
                if labelled:
                    ok &= data["label"][two] != data["label"][two + 1]
                found.append(np.stack([two[ok], two[ok] + 1], axis=1))
            for a, b in zip(bounds[:done].tolist(), bounds[1 : done + 1].tolist()):
                if b - a > 2:
                    found.append(pairs({k: v[a:b] for k, v in data.items()}) + a)
            at = np.concatenate([*found, np.empty((0, 2), np.int64)])
            node = data["node"]
            x, y = node[at[:, 0]], node[at[:, 1]]
            out = [np.minimum(x, y), np.maximum(x, y), data["key"][at[:, 0]], data["i"][at[:, 0]], data["j"][at[:, 0]]]
            kept = size if last else bounds[done]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=EDGES.names), {k: v[kept:] for k, v in data.items()}

        for batch in batches:
            data = {c: np.asarray(batch.column(c)) for c in names}
            data["n"] = data["n"].astype(np.int64)
            data["bits"] = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(-1, tuning.bits // 64)
            if rest is not None:
                data = {k: np.concatenate([rest[k], v]) for k, v in data.items()}
            if len(data["key"]):
                out, rest = batch_pairs(data, False)
                yield out
        if rest is not None and len(rest["key"]):
            yield batch_pairs(rest, True)[0]

    return spread.mapInArrow(run, EDGES)


def class_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The texts of the ``members``, one row of each class: by id and text, and by text where the id is null.

    Copies without an id can't be told apart, so of their equal texts one is kept.
    """
    keyed = id_text(docs).withColumn("text_key", F.xxhash64("text"))
    named = keyed.join(members.where(F.col("doc_id").isNotNull()), ["doc_id", "text_key"], "left_semi").select("text")
    nameless = keyed.where(F.col("doc_id").isNull()).join(members.where(F.col("doc_id").isNull()), "text_key", "left_semi").select("text").distinct()
    return named.unionByName(nameless)


def verified(pairs: DataFrame, docs: DataFrame, ids: DataFrame, words: int, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of classes with ``linked``: whether their whole sets are similar.

    ``ids``: node, and doc_id and text_key of one row of its class, whose text is shingled again.
    """
    pairs = staged(pairs.select("a", "b").distinct())
    if pairs.isEmpty():
        return pairs.withColumn("linked", F.lit(False))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = class_texts(docs, ids.join(wanted, "node", "left_semi").select("doc_id", "text_key"))
    schema = struct_type(node=T.LongType(), elements=T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, sets)]).astype(np.int32), flat)
            yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), lists], names=schema.names)

    sets = texts.mapInArrow(run, schema).dropDuplicates(["node"])
    sets = staged(sets)
    first = pairs.join(sets.withColumnsRenamed({"node": "a", "elements": "x"}), "a")
    both = first.join(sets.withColumnsRenamed({"node": "b", "elements": "y"}), "b")
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return staged(both.select("a", "b", (100 * shared >= percent * union).alias("linked")))


def remaining_links(docs: DataFrame, ids: DataFrame, entries: DataFrame, edges: DataFrame, checked: DataFrame, labels: DataFrame, words: int, percent: int, tuning: Tuning) -> DataFrame:
    """Links between components in those entries whose forest had an edge that failed."""
    failed = staged(edges.join(checked.where(~F.col("linked")), ["a", "b"], "left_semi").select("key", "i", "j").distinct())
    if failed.isEmpty():
        return checked.select("a", "b").limit(0)
    left = entries.join(failed, ["key", "i", "j"], "left_semi").join(labels.withColumnRenamed("component_id", "label"), "node", "left")
    again = entry_pairs(left.withColumn("label", F.coalesce("label", "node")), percent, labelled=True, tuning=tuning)
    return verified(again.join(checked, ["a", "b"], "left_anti"), docs, ids, words, percent).where("linked").select("a", "b")


def similar_components(docs: DataFrame, words: int, percent: int, tuning: Tuning = TUNING) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of ``docs``."""
    whole = staged(document_sets(docs, words, percent, tuning))
    sets = staged(whole.select("doc_id", "text_key", "node", "n"))
    classes = staged(whole.where("n > 0").groupBy("node").agg(F.min(F.struct("n", "prefix", "bits")).alias("s")).select("node", "s.*"))
    discard(whole)  # sets and classes hold what is needed of it
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    ids = staged(sets.where("n > 0").groupBy("node").agg(F.min(row).alias("row")).select("node", "row.doc_id", "row.text_key"))
    entries = staged(index(classes, percent, tuning))
    edges = staged(entry_pairs(entries, percent, labelled=False, tuning=tuning))
    checked = verified(edges, docs, ids, words, percent)
    links = checked.where("linked").select("a", "b")
    labels = staged(components(links))
    late = remaining_links(docs, ids, entries, edges, checked, labels, words, percent, tuning)
    if not late.isEmpty():
        labels = staged(components(links.union(late)))
    members = ids.join(labels, "node", "left").select("node", "doc_id", F.coalesce("component_id", "node").alias("component"))
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = staged(members.join(least, "component").select("node", "component_id"))
    return sets.join(by_node, "node", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
