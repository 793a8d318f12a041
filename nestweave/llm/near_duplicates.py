"""Near-duplicate documents by MinHash bands with sequential Bayesian verification.

Documents with equal shingle sets form a class; everything after works on one node per class.
MinHash signatures are cut into bands, and nodes that agree on a band share a bucket. Pairs of a
bucket are compared signature batch by signature batch: with a uniform prior, n compared hashes
of which m agree leave P(similarity >= t) = P(Binomial(n + 1, t) <= m), and a pair goes as soon
as that is below the chosen miss probability. Survivors are confirmed on their full sets.

A bucket never emits all its pairs. First each member meets its bucket's lead, the node that shares
most buckets with others. Two members that are similar and share no shingle outside the lead's set both
have much of it: their common shingles are all in it. So members are dealt anew, by each shingle that the
lead does not have and, those with enough of the lead's set, by the size of the smaller one. Of the
shingles the rarest come first, and only those count that can be the first that two similar members share: there
are few of them, and a line or passage that many texts hold is not among them. What is
similar still meets, and what shares just a common core or a common line no longer does. Of several leads that two members share, the primary
one (most central) is enough. In the small buckets that are left
with several components, members outside the largest one meet the others, some in every round.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nestweave.llm.components import components
from nestweave.llm.storage import discard, stage
from nestweave.llm.words import mix, shingles, slices, words

WORDS = 5
THRESHOLD = 0.8
BANDS = 30
BAND_ROWS = 5
#: Hashes compared before the next look at the posterior.
BATCH = 30
MISS = 1e-6
#: Leaders that a dealt bucket has at most in a round: all members outside the largest component, if they are
#: no more.
SLOTS = 1024
#: Sizes of the classes that members are dealt by grow by this factor.
GROWTH = 1.02
#: Keys that are handed on at a time.
KEYS = 1 << 16
#: Pairs of one node from which its values are copied, and so many times, for a join.
HEAVY, COPIES = 1000, 32
#: Ids of at most so many nodes (8 bytes each) are broadcast; beyond, the join shuffles.
BROADCAST_NODES = 1_000_000
#: Nodes of classes without any document id lie here; document ids are below.
_NO_ID = 1 << 62


def least_matches(hashes: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """For each look (hashes compared so far), the fewest matches that a pair may have.

    ``threshold`` is how likely hashes match: signatures keep one byte of each, so that others
    match once in 256 times (:func:`of_bytes`).
    """

    def tail(n: int, m: int) -> float:
        return sum(comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))

    looks = [*range(batch, hashes, batch), hashes]
    return [(n, next(m for m in range(n + 1) if tail(n, m) >= miss)) for n in looks]


def of_bytes(similarity: float) -> float:
    """How likely the last bytes of two MinHash values are equal."""
    return similarity + (1 - similarity) / 256


def signatures(docs: DataFrame, id: str, text: str, size: int, bands: int, band_rows: int) -> DataFrame:
    """Per document: id, number of shingles, a 128-bit fingerprint of the set, the keys of its bands
    and the last byte of each MinHash value."""
    hashes = bands * band_rows
    rng = np.random.default_rng(7)
    flips = rng.integers(0, 1 << 32, hashes, dtype=np.uint32)
    factors = rng.integers(0, 1 << 31, hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, value = shingles(words(batch.column("text"), lower=True), size)
            counts = np.bincount(row, minlength=batch.num_rows)
            some = np.flatnonzero(counts)
            first = (np.cumsum(counts) - counts)[some]
            prints = np.zeros((2, batch.num_rows), np.uint64)
            least = np.zeros((batch.num_rows, hashes), np.uint32)
            if len(some):
                prints[0, some] = np.add.reduceat(value, first)
                prints[1, some] = np.add.reduceat(mix(value ^ np.uint64(hashes + 1)), first)
                high = (mix(value) >> np.uint64(32)).astype(np.uint32)
                for k in range(hashes):
                    least[some, k] = np.minimum.reduceat((high ^ flips[k]) * factors[k], first)
            low = least.astype(np.uint8).tobytes()
            parts = least.reshape(batch.num_rows, bands, band_rows)
            key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (batch.num_rows, bands))
            for k in range(band_rows):
                key = mix(key ^ parts[:, :, k].astype(np.uint64)) + np.uint64(1)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(prints[0].view(np.int64)),
                    pa.array(prints[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(key.reshape(-1).view(np.int64))),
                    pa.array([low[k * hashes : (k + 1) * hashes] for k in range(batch.num_rows)], pa.binary()),
                ],
                ["id", "n_shingles", "print_1", "print_2", "keys", "signature"],
            )

    plain = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(
        run, "id long, n_shingles long, print_1 long, print_2 long, keys array<long>, signature binary"
    )


def _both(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """Staged pairs (a, b) with a value of either node, as of_a and of_b.

    A node of very many pairs is copied, so that its pairs do not meet in one task. Values of nodes without
    pairs do not move, if the nodes with some are few enough to broadcast.
    """
    out = pairs
    for side, other in (("b", "a"), ("a", "b")):
        wanted = pairs.select(F.col(side).alias("node")).distinct()
        of = values.select("node", F.col(value).alias(f"of_{side}"))
        if wanted.count() <= BROADCAST_NODES:
            of = of.join(F.broadcast(wanted), "node", "left_semi")
        heavy = pairs.groupBy(side).agg(F.count("*").alias("n")).where(F.col("n") > HEAVY)
        heavy = heavy.select(side, F.lit(COPIES).alias("copies"))
        copies = F.coalesce("copies", F.lit(1))
        out = out.join(heavy, side, "left").withColumn("copy", F.pmod(F.xxhash64(other), copies).cast("int")).drop("copies")
        of = of.withColumnRenamed("node", side).join(heavy, side, "left")
        of = of.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")
        out = out.join(of, [side, "copy"]).drop("copy")
    return out.select(*pairs.columns, "of_a", "of_b")


def _plausible(pairs: DataFrame, nodes: DataFrame, looks: list[tuple[int, int]]) -> DataFrame:
    """Pairs (a, b) that no look at their signatures rules out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for c in ("of_a", "of_b")
            )
            left, seen = np.arange(batch.num_rows), 0
            matches = np.zeros(batch.num_rows, np.int64)
            for upto, least in looks:
                matches[left] += (one[left, seen:upto] == two[left, seen:upto]).sum(axis=1)
                left, seen = left[matches[left] >= least], upto
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(left)), batch.column("b").take(pa.array(left))], ["a", "b"]
            )

    return _both(pairs, nodes, "signature").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """The shingle set of each wanted node (node, id), from its document's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            row, value = shingles(words(batch.column("text"), lower=True), size)
            bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows))))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(value.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), lists], ["node", "shingles"])

    plain = docs.select(F.col(id).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    few = wanted.count() <= BROADCAST_NODES
    found = plain.join(F.broadcast(wanted) if few else wanted, "node", "left_semi")
    return found.mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    both = F.size(F.array_intersect("of_a", "of_b"))
    percent = round(100 * threshold)
    of_both = _both(pairs, sets, "shingles")
    return of_both.where(100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)).select("a", "b")


def dealt_keys(lead: np.ndarray, own: np.ndarray, salt: int, percent: int) -> tuple[np.ndarray, int]:
    """Keys of the buckets that a member is dealt to, from the sets of its lead and its own; what both share.

    Members x and y with ``|x & y| (100 + percent) >= percent (|x| + |y|)`` share a shingle outside
    the lead's set, or else both have as many of the lead's: they get the class of the smaller size.
    """
    inside = np.isin(own, lead, assume_unique=True)
    outside = own[~inside].view(np.uint64)
    common, n = int(inside.sum()), len(own)
    # classes from the least size that can be similar up to the own one
    first = int(np.floor(np.log(max(percent * n / 100, 1)) / np.log(GROWTH))) - 1
    last = int(np.floor(np.log(n) / np.log(GROWTH))) + 1
    classes = np.arange(max(first, 0), last + 1)
    lowest = np.ceil(GROWTH**classes - 1e-9)
    fits = common * (100 + percent) >= percent * (n + np.minimum(lowest, n))
    seed = mix(np.array([salt], np.int64).view(np.uint64) + np.uint64(1))[0]
    sizes = mix(classes[fits].astype(np.uint64) + np.uint64(1)) ^ np.uint64(0x5555555555555555)
    return mix(np.concatenate((outside, sizes)) ^ seed).view(np.int64), common


def _dealt(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Members anew, as (key, sized, node, lead, primary, inside, size), from leads (a), members (b) and
    their primary leads: ``sized`` tells keys by size from those by shingle, ``lead`` is the key's lead, and the numbers are of the member's
    shingles that are in the lead's set, and of all."""
    percent = round(100 * threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("of_a"), batch.column("of_b")
            ends = [batch.column(c).to_pylist() for c in ("a", "b", "primary")]
            keys, rows, sized, waiting = [], [], [], 0
            for k, (lead, node, primary) in enumerate(zip(*ends, strict=True)):
                one, two = (x[k].values.to_numpy() for x in lists)
                some, common = dealt_keys(one, two, lead, percent)
                keys.append(some)
                by_size = np.arange(len(some)) >= len(two) - common  # the others are by shingle
                rows.append((node, lead, primary, common, len(two)))
                sized.append(by_size)
                waiting += len(some)
                if waiting >= KEYS or k == batch.num_rows - 1:
                    columns = np.repeat(np.array(rows, np.int64), list(map(len, keys)), axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(keys)),
                            pa.array(np.concatenate(sized).astype(np.int64)),
                            *(pa.array(columns[:, j]) for j in range(5)),
                        ],
                        ["key", "sized", "node", "lead", "primary", "inside", "size"],
                    )
                    keys, rows, sized, waiting = [], [], [], 0

    return _both(pairs, sets, "shingles").mapInArrow(
        run, "key long, sized long, node long, lead long, primary long, inside long, size long"
    )


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = WORDS,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    miss: float = MISS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are folded to lower case (A to Z). A document's set is its distinct shingles of ``size``
    words, or its whole sequence if it has fewer. Documents are linked at a Jaccard similarity of
    ``threshold`` or more (in whole percent); ``component_id`` is the smallest id a document
    reaches and ``kept`` says that it is the document's own.

    Null or empty texts have no shingles, stand alone and are kept. Repeated rows get equal
    rows. A row without an id joins documents with the same set (component_id: theirs, kept:
    false); if none has an id, component_id is null and the row is kept. Ids lie below 2^62.
    """
    looks = least_matches(bands * band_rows, BATCH, of_bytes(threshold), miss)
    signed = stage(signatures(docs, id, text, size, bands, band_rows), "signatures")
    prints = ["print_1", "print_2"]
    classes = stage(
        signed.where("n_shingles > 0")
        .groupBy(*prints)
        .agg(F.min("id").alias("id"))
        .withColumn("node", F.coalesce("id", F.lit(_NO_ID) + F.shiftrightunsigned("print_1", 2))),
        "classes",
    )
    nodes = stage(
        signed.where("id is not null and n_shingles > 0")
        .join(classes.where("id is not null").drop("node"), [*prints, "id"])
        .dropDuplicates([*prints, "id"])
        .select(F.col("id").alias("node"), "keys", "signature"),
        "nodes",
    )
    links = _links(docs, nodes, id, text, size, threshold, looks)
    labels = classes.join(links, "node", "left").select(
        *prints, F.coalesce("label", "node").alias("label")
    )
    sorted_out = signed.drop("signature", "keys").join(stage(labels, "labels"), prints, "left")
    label = F.when(F.col("label") < _NO_ID, F.col("label"))
    component = F.when(F.col("n_shingles") > 0, label).otherwise(F.col("id"))
    return sorted_out.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _labelled(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """Members with the label of their component, a node without links being its own."""
    if found is None:
        return members.withColumn("label", F.col("node"))
    return members.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _mixed(members: DataFrame, key: str, found: DataFrame | None) -> DataFrame:
    """Members with labels and their bucket's size n, of the buckets that hold more than one component."""
    labelled = _labelled(members.drop("label", "n"), found)
    of_key = F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")
    return labelled.join(labelled.groupBy(key).agg(*of_key).where("low < high").select(key, "n"), key)


def _first(members: DataFrame, threshold: float) -> DataFrame:
    """Dealt members of mixed buckets without the shingles that cannot be the first that two similar ones share.

    A member's shingles outside its lead's set go by the sizes of their buckets, those of one component, which
    members of two never share, before all. Two members share at most what either has in the lead's set
    and, as ``rest``, from the first common one on: for similar ones that is the threshold's share of either.
    """
    order = Window.partitionBy("node", "lead").orderBy(F.desc("n"), F.desc("key"))
    by_shingle = members.where("sized = 0").withColumn("rest", F.row_number().over(order).cast("long"))
    some = by_shingle.where(100 * (F.col("inside") + F.col("rest")) >= round(100 * threshold) * F.col("size"))
    return some.unionByName(members.where("sized = 1").withColumn("rest", F.lit(0).cast("long")))


def _links(docs, nodes, id, text, size, threshold, looks) -> DataFrame:
    """The component label of each node that is linked with another, as (node, label)."""
    none = docs.sparkSession.createDataFrame([], "node long, label long")
    banded = nodes.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(banded.join(shared, "key"), "members")
    if members.isEmpty():
        return none
    sets = stage(_sets(docs, members.select("node").distinct(), id, text, size), "sets")
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    lead = F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("lead")
    leads = members.join(weight, "node").groupBy("key").agg(lead).select("key", "lead.weight", (-F.col("lead.minus")).alias("a"))
    led = members.join(leads, "key").where("node <> a").select("a", F.col("node").alias("b"), "weight").distinct()
    led = stage(led, "met")
    met = led.select("a", "b")
    discard(members)
    linked = stage(_confirmed(stage(_plausible(met, nodes, looks), "plausible"), sets, threshold), "confirmed")
    found = None if linked.isEmpty() else stage(_merged(None, linked), "found")
    # members of one lead that are not all in one component
    open_ = _mixed(met.select("a", F.col("b").alias("node")), "a", found).select("a", F.col("node").alias("b"))
    first = F.max(F.struct("weight", (-F.col("a")).alias("minus"))).alias("first")
    primary = led.groupBy("b").agg(first).select("b", (-F.col("first.minus")).alias("primary"))
    open_ = open_.join(primary, "b").select("a", "b", "primary")
    dealt = stage(_dealt(stage(open_, "open"), sets, threshold), "dealt")
    mixed = stage(_mixed(dealt, "key", found), "mixed")
    members = stage(_mixed(_first(mixed, threshold), "key", found), "members")
    seen = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    discard(dealt, mixed)
    number, percent = 0, round(100 * threshold)
    leading = ("node", "label", "primary", "inside", "rest", "size", "largest", "others")
    while not members.isEmpty():
        # some members outside the bucket's largest component meet all others, and leave it
        number += 1
        largest = members.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
            F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n")
        )
        largest = stage(largest.select("key", F.col("most.label").alias("largest"), (F.col("n") - F.col("most.n")).alias("others")), "largest")
        dealt_out = F.pmod(F.xxhash64("node", F.lit(number)), F.lit(SLOTS))
        slot = F.when(F.col("others") <= SLOTS, F.col("node")).otherwise(dealt_out).alias("slot")
        leaders = stage(
            members.join(largest, "key")
            .where("label <> largest")
            .groupBy("key", slot)
            .agg(F.min(F.struct(*leading)).alias("lead"))
            .select("key", *(F.col(f"lead.{c}").alias(f"lead_{c}") for c in leading)),
            "leaders",
        )
        # members with the same primary lead meet in its buckets only
        here = (F.col("primary") == F.col("lead")) | (F.col("primary") != F.col("lead_primary"))
        # where all others lead, two of them meet once
        once = (F.col("label") == F.col("lead_largest")) | (F.col("node") < F.col("lead_node")) | (F.col("lead_others") > SLOTS)
        # as many shingles as two members can share, in the set of the key's lead and outside from this key on;
        # those that are dealt by size share none outside
        most = F.least("inside", "lead_inside") + F.least("rest", "lead_rest")
        enough = most * (100 + percent) >= percent * (F.col("size") + F.col("lead_size"))
        pairs = (
            members.join(leaders, "key")
            .where((F.col("label") != F.col("lead_label")) & here & once & enough)
            .select(F.least("node", "lead_node").alias("a"), F.greatest("node", "lead_node").alias("b"))
            .distinct()
            .join(seen, ["a", "b"], "left_anti")
        )
        pairs = stage(pairs, "pairs")
        linked = stage(_confirmed(stage(_plausible(pairs, nodes, looks), "plausible"), sets, threshold), "confirmed")
        if not linked.isEmpty():
            found = stage(_merged(found, linked), "found")
        # where all others have met everything, the bucket is done
        left = members.drop("label").join(largest.where(F.col("others") > SLOTS).select("key"), "key", "left_semi")
        rest = left.join(leaders.select("key", F.col("lead_node").alias("node")), ["key", "node"], "left_anti")
        after = stage(_mixed(rest, "key", found), "members")
        discard(members, leaders, linked, largest)
        members, seen = after, seen.unionByName(pairs)
    return none if found is None else found


def _merged(found: DataFrame | None, linked: DataFrame) -> DataFrame:
    """Labels after more links: the links' components, and what pointed at their labels."""
    if found is None:
        return components(linked)
    ends = linked
    for side in ("a", "b"):
        known = found.select(F.col("node").alias(side), F.col("label").alias("was"))
        ends = ends.join(known, side, "left").withColumn(f"of_{side}", F.coalesce("was", side)).drop("was")
    fresh = stage(components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "components")
    moved = fresh.select(F.col("node").alias("label"), F.col("label").alias("new"))
    old = found.join(moved, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    return old.unionByName(fresh.join(found, "node", "left_anti"))
