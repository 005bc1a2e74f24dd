"""N-gram Jaccard join with PartEnum signatures.

Sets of word shingles fall into size bands that are as wide as the similarity allows, so similar sets are in the same band
or in neighbouring ones; each set takes part in the join of its own band and of the next. In a join of sets of at most
``s`` elements, similar sets differ in at most ``k = 2s(1-t)/(1+t)`` elements. The domain of shingles is partitioned by
hash on two levels; at most ``k`` differences leave a first-level part in which at most one of its three second-level
parts differs. So one of the three pairs of second-level parts agrees, and the contents of each pair are a signature.

An empty pair would be shared by unrelated sets. There are some first-level parts to spare, so a set with few empty parts
shares a signature that is not empty with each set similar to it. Only two sets with too many empty parts ("thin" ones) can
fail to. So thin sets also have their rarest-by-hash elements as signatures: similar sets share one of the first
(size - least overlap + 1) elements in the order of a hash. No signature is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from caselight.llm import hashing as H
from caselight.llm.common import attach, partitions, stored, wide_key, wrapped
from caselight.llm.components import components

SIGNATURES_PER_SHARD = 500_000
#: Most ids that are sent to all executors; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


class Bands:
    """Size bands of a similarity ``percent`` and the partitions of the join of each band."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        self.low, self.high, self.k, self.parts, self.fine, self.spare = [], [], [], [], [], []
        low = 1
        while low <= largest:
            high = max(low, low * 100 // percent)
            k = 2 * high * (100 - percent) // (100 + percent)
            self.low.append(low)
            self.high.append(high)
            self.k.append(k)
            spare = 0 if k <= 3 else 1 + (k // 2) // 8
            self.parts.append(1 if k <= 3 else k // 2 + 1 + spare)
            self.fine.append(k + 2 if k <= 3 else 3)
            self.spare.append(spare)
            low = high + 1
        for name in ("low", "high", "k", "parts", "fine", "spare"):
            setattr(self, name, np.array(getattr(self, name), np.int64))

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, sizes, side="right") - 1


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where those of each text start and end."""
    data, at = H.flat(column)
    starts, ends, bounds = H.word_spans(data, at)
    words = H.word_hashes(data, starts, ends, lower=True)
    grams = H.gram_hashes(words, n)
    out, sizes = [], [0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= n:
            found = np.unique(grams[a:b - n + 1])
        elif b > a:
            found = H.gram_hashes(words[a:b], b - a) ^ np.uint64(b - a)
        else:
            found = words[:0]
        out.append(found)
        sizes.append(len(found))
    return (np.concatenate(out) if out else words[:0]), np.cumsum(sizes)


def set_prints(items: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit print per set; 0 for an empty one."""
    run = np.zeros(len(items) + 1, np.uint64)
    np.cumsum(H.mix(items + np.uint64(77)), out=run[1:])
    sizes = np.diff(bounds)
    prints = H.mix(run[bounds[1:]] - run[bounds[:-1]] + sizes.astype(np.uint64)) | np.uint64(1)
    return np.where(sizes > 0, prints, np.uint64(0))


def signatures(items: np.ndarray, bounds: np.ndarray, bands: Bands, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets in the join of their own band (``step`` 0) or the next (1), and the set of each."""
    sizes = np.diff(bounds)
    band = bands.of(np.maximum(sizes, 1)) + step
    parts, fine, spare = bands.parts[band], bands.fine[band], bands.spare[band]
    active = (sizes > 0) & (bands.k[band] > 0)
    cells_of = np.where(active, parts * fine, 0)
    base = np.concatenate([[0], np.cumsum(cells_of)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    used = active[owner]
    owner, values = owner[used], items[used]
    spread = H.mix(values)
    first = ((spread >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    second = ((spread & np.uint64(0xFFFFFFFF)) * fine[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    cell = base[owner] + first * fine[owner] + second
    sums = np.zeros(base[-1], np.uint64)
    np.add.at(sums, cell, H.mix(values ^ np.uint64(0x5851F42D4C957F2D)))
    full = np.zeros(base[-1], bool)
    full[cell] = True
    found, owners, needy = [], [], np.zeros(len(sizes), bool)
    for width in np.unique(fine[active]).tolist():
        sets = np.flatnonzero(active & (fine == width))
        part_of = np.repeat(sets, parts[sets])
        part_no = np.arange(len(part_of)) - np.repeat(np.cumsum(parts[sets]) - parts[sets], parts[sets])
        start = base[part_of] + part_no * width
        filled = [full[start + j] for j in range(width)]
        weak = (width - sum(f.astype(np.int64) for f in filled)) >= 2
        weak_parts = np.bincount(part_of, weak, minlength=len(sizes)).astype(np.int64)
        needy[sets] |= (weak_parts > spare)[sets]
        tag = H.mix((band[part_of].astype(np.uint64) << np.uint64(40)) + part_no.astype(np.uint64))
        for x in range(width):
            for y in range(x + 1, width):
                keep = filled[x] | filled[y]
                sums_here = sums[start[keep] + x] + sums[start[keep] + y]
                found.append(H.mix(sums_here ^ (tag[keep] + np.uint64(x * 64 + y))))
                owners.append(part_of[keep])
    for i in np.flatnonzero(needy).tolist():
        first = np.sort(H.mix(items[bounds[i]:bounds[i + 1]] + np.uint64(33)))[:prefix_size(int(sizes[i]), bands.percent)]
        found.append(H.mix(first ^ np.uint64(0x2545F4914F6CDD1D)))
        owners.append(np.full(len(first), i))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def prefix_size(size: int, percent: int) -> int:
    """How many elements, the first in any one order, hold one of those that a similar set shares."""
    return size + (-percent * size) // 100 + 1


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("key", wide_key(F.col("id"), F.col("text")))


def _shards(sets: DataFrame, bands: Bands, n: int, shards: int) -> DataFrame:
    """One row per batch and shard: the signatures of the batch that belong there, packed.

    Within a shard five bytes tell signatures apart: shards grow in number, not in size.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.pieces(batch, "text"):
                items, bounds = shingle_sets(part.column("text"), n)
                prints = set_prints(items, bounds)
                prints, first = np.unique(prints, return_index=True)  # equal sets of a batch count once
                first = first[prints > 0]
                sizes = np.diff(bounds)[first]
                kept = np.concatenate([items[bounds[i]:bounds[i + 1]] for i in first]) if len(first) else items[:0]
                limits = np.concatenate([[0], np.cumsum(sizes)])
                own = set_prints(kept, limits)
                found = [signatures(kept, limits, bands, step) for step in (0, 1)]
                sig = np.concatenate([f[0] for f in found])
                owner = np.concatenate([f[1] for f in found])
                shard = (sig % np.uint64(shards)).astype(np.int64)
                low = sig // np.uint64(shards) & np.uint64((1 << 40) - 1)
                order = np.lexsort((owner, shard))
                shard, low, owner = shard[order], low[order], owner[order]
                numbers, starts = np.unique(shard, return_index=True)
                ends = np.append(starts[1:], len(shard))
                sigs, keys, counts = [], [], []
                for a, b in zip(starts.tolist(), ends.tolist()):
                    sigs.append(low[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes())
                    who, times = np.unique(owner[a:b], return_counts=True)
                    keys.append(own[who].tobytes())
                    counts.append(times.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int32()), *(pa.array(x, pa.binary()) for x in (sigs, keys, counts))],
                    ["shard", "sigs", "keys", "counts"])

    return sets.select("text").mapInArrow(pack, "shard int, sigs binary, keys binary, counts binary")


def _lists(packed: DataFrame) -> DataFrame:
    """The different lists of prints that share a signature, each once: list_id and members, in one order everywhere."""
    def find(key, table):
        del key
        sig, prints = [], []
        for s, k, c in zip(*(table.column(name).to_pylist() for name in ("sigs", "keys", "counts"))):
            raw = np.zeros((len(s) // 5, 8), np.uint8)
            raw[:, :5] = np.frombuffer(s, np.uint8).reshape(-1, 5)
            sig.append(raw.view("<u8").ravel())
            prints.append(np.repeat(np.frombuffer(k, "<u8"), np.frombuffer(c, "<u4")))
        sig, prints = np.concatenate(sig), np.concatenate(prints)
        order = np.lexsort((prints, sig))
        sig, prints = sig[order], prints[order].view(np.int64)
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (prints[1:] != prints[:-1])
        sig, prints = sig[new], prints[new]
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        start = np.flatnonzero(new)
        sizes = np.diff(np.append(start, len(sig)))
        start, sizes = start[sizes > 1], sizes[sizes > 1]
        run = np.zeros(len(prints) + 1, np.uint64)
        np.cumsum(H.mix(prints.view(np.uint64) + np.uint64(77)), out=run[1:])
        names = H.mix(run[start + sizes] - run[start] + sizes.astype(np.uint64)).view(np.int64)
        names, first = np.unique(names, return_index=True)
        start, sizes = start[first], sizes[first]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(start, sizes)
        return pa.table({"list_id": pa.array(names, pa.int64()), "members": pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(prints[places], pa.int64()))})

    lists = packed.groupBy("shard").applyInArrow(find, "list_id long, members array<long>")
    return lists.groupBy("list_id").agg(F.first("members").alias("members"))


def sketch(items: np.ndarray) -> np.ndarray:
    """Parities of the set over cells, about three cells for two elements, as 64-bit words; the words are a power of two.

    Cells whose parities differ hold at least one element that only one of two sets has, so the number of differing bits
    never exceeds the number of differing elements: a filter that loses nothing. Folding halves onto each other gives the
    sketch with half the cells.
    """
    words = 1
    while words * 64 < 1.5 * len(items):
        words *= 2
    odd = np.bincount((H.mix(items + np.uint64(5)) & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<u8")


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and sketches leave possible."""
    narrow = sets.select("print", F.size("items").alias("n"), "sketch")
    both = (pairs.join(narrow.select(F.col("print").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x")), "a")
            .join(narrow.select(F.col("print").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y")), "b")
            .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def fold(name: str, other: str):
        half = (F.size(name) / 2).cast("int")
        folded = F.zip_with(F.slice(name, F.lit(1), half), F.slice(name, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(name) > F.size(other), folded).otherwise(F.col(name))  # sizes this near differ by one fold

    bits = F.aggregate(F.zip_with(fold("x", "y"), fold("y", "x"), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0),
                       lambda acc, v: acc + v)
    return both.filter((100 + percent) * bits <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b), stored, whose sets are similar enough, by exact intersection; only their sets are moved."""
    needed = stored(pairs.select(F.col("a").alias("print")).unionByName(pairs.select(F.col("b").alias("print"))).distinct(),
                    "needed")
    some = attach(sets.select("print", "items"), needed, "print", "left_semi")
    both = pairs.join(some.withColumnsRenamed({"print": "b", "items": "y"}), "b").join(
        some.withColumnsRenamed({"print": "a", "items": "x"}), "a")
    shared = F.size(F.array_intersect("x", "y"))
    return both.withColumn("shared", shared).filter(
        100 * F.col("shared") >= percent * (F.size("x") + F.size("y") - F.col("shared"))).select("a", "b").distinct()


def _closest(lists: DataFrame, percent: int, most: int) -> DataFrame:
    """(list_id, a, b): for each component of each list, the pairs with other components that sketches find the closest.

    ``lists`` has one row per list: nodes, labels, sizes and sketches of its members, and which nodes were compared with
    them before. Pairs that sizes and sketches rule out, or that were compared, are left out, so a list that gives no row
    holds no link that is still missing. A component has ``most`` rows of a list at most, however large the list.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for i, list_id in enumerate(batch.column("list_id").to_pylist()):
                nodes, labels, sizes = (batch.column(x)[i].values.to_numpy() for x in ("nodes", "labels", "sizes"))
                sketches, compared = batch.column("sketches")[i].values, batch.column("compared")[i].values
                out.extend((list_id, a, b) for a, b in pairs_of(nodes, labels, sizes, folded(sketches), compared.to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else ([], [], []))],
                                             ["list_id", "a", "b"])

    def folded(sketches: pa.ListArray) -> np.ndarray:
        """The sketches as rows of one matrix, all folded to the length of the shortest."""
        lengths = sketches.value_lengths().to_numpy()
        ends = np.cumsum(lengths)
        values, words = sketches.flatten().to_numpy().view(np.uint64), int(lengths.min())
        bits = np.zeros((len(lengths), words), np.uint64)
        for i, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
            own = values[end - length:end]
            while len(own) > words:
                own = own[:len(own) // 2] ^ own[len(own) // 2:]
            bits[i] = own
        return bits

    def pairs_of(nodes: np.ndarray, labels: np.ndarray, sizes: np.ndarray, bits: np.ndarray, compared: list) -> set[tuple[int, int]]:
        places = {node: i for i, node in enumerate(nodes.tolist())}
        best: dict[int, list[tuple[int, int, int]]] = {}
        for i in range(len(nodes)):
            differ = np.bitwise_count(bits ^ bits[i]).sum(axis=1, dtype=np.int64)
            total, least = sizes + sizes[i], np.minimum(sizes, sizes[i])
            fits = ((labels != labels[i]) & ((100 + percent) * differ <= (100 - percent) * total)
                    & (100 * least >= percent * (total - least)))
            fits[[places[x] for x in compared[i] or () if x in places]] = False
            found = np.flatnonzero(fits)
            if len(found) > most:
                found = found[np.argsort(differ[found], kind="stable")[:most]]
            kept = best.setdefault(int(labels[i]), [])
            kept.extend((int(differ[j]), i, j) for j in found.tolist())
            if len(kept) > most:
                kept.sort()
                del kept[most:]
        return {(min(int(nodes[i]), int(nodes[j])), max(int(nodes[i]), int(nodes[j]))) for kept in best.values() for _, i, j in kept}

    return lists.mapInArrow(compare, "list_id long, a long, b long")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
                   ) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, set_id (the print of its set; 0 for an empty one).

    The set of a text holds its distinct ``n``-word shingles, A-Z as a-z; a text with fewer words is one shingle, one
    without words (or null) has an empty set, links with nothing and is its own component, as are all rows with such a
    text. Texts link when their sets have a Jaccard similarity of ``percent`` or more; ``component_id`` is the least id
    that links reach (null ids come last). Equal sets are one class, so copies are never paired. Other columns are not
    read. Shingles are compared by 64-bit hashes.

    Sets that share a signature are first compared with the least of them, then with the one that has most links. What that
    leaves in different components is compared in rounds, the closest pairs of two components first, until none is left that
    could be similar. So no missing link joins two components, and a group of near copies is not expanded into its pairs.
    """
    return _grouped(docs, id_col, text_col, n, percent).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", F.col("print").alias("set_id"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
                 ) -> DataFrame:
    """The rows of ``docs`` whose id is that of their group, with all their columns; rows with an empty set stay."""
    rows = _grouped(docs, id_col, text_col, n, percent)
    gone = stored(rows.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select("key").distinct(), "similar")
    return attach(wrapped(docs, id_col, text_col), gone, "key", "left_anti").select("row.*")


def _grouped(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    bands, texts = Bands(percent), _texts(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.pieces(batch, "text"):
                items, bounds = shingle_sets(part.column("text"), n)
                sizes = np.diff(bounds)
                band = bands.of(np.maximum(sizes, 1))
                many = sum(bands.parts[band + s] * bands.fine[band + s] * (bands.fine[band + s] - 1) // 2 for s in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array(sizes, pa.int64()),
                     pa.array(set_prints(items, bounds).view(np.int64), pa.int64()), pa.array(many, pa.int64())],
                    ["id", "key", "n_shingles", "print", "n_signatures"])

    members = stored(texts.select("id", "key", "text").mapInArrow(
        describe, f"id {kind}, key struct<a:bigint,b:bigint>, n_shingles long, print long, n_signatures long"), "sets")
    total = members.agg(F.sum("n_signatures")).first()[0] or 0
    shards = max(partitions(spark), total // SIGNATURES_PER_SHARD + 1)
    lists = stored(_lists(_shards(texts, bands, n, shards)), "lists")

    wanted = lists.select(F.explode("members").alias("print")).distinct()
    classes = members.filter("print <> 0").groupBy("print").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("rep"))
    classes = stored(classes.select("print", F.col("rep.id").alias("rep_id")), "classes")
    chosen = stored(classes.join(wanted, "print").select("print", "rep_id"), "chosen")
    sets = stored(_sets_of(spark, texts, chosen, n), "chosen_sets")

    pairs = lists.select(F.element_at("members", 1).alias("a"),
                         F.explode(F.expr("slice(members, 2, size(members))")).alias("b")).distinct()
    links = stored(_verified(stored(_near(pairs, sets, percent), "near"), sets, percent), "links")
    labels = stored(components(links), "labels")

    # Once more against the member with most links so far: in a group of near copies that is the text they all come from.
    degrees = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).groupBy("node").agg(
        F.count("*").alias("degree"))
    known = stored(labels.join(degrees, "node", "left").select("node", "label", F.coalesce("degree", F.lit(0)).alias("degree")),
                   "degrees")
    ranked = lists.select("list_id", F.explode("members").alias("node")).join(known, "node", "left").groupBy("list_id").agg(
        F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "node", F.coalesce("label", "node").alias("label"))).alias("hub"),
        F.collect_list(F.struct("node", F.coalesce("label", "node").alias("label"))).alias("m"))
    again = ranked.select(F.col("hub.node").alias("centre"), F.explode(F.filter(
        "m", lambda x: x["label"] != F.col("hub.label"))).alias("x")).select(
        F.least("centre", "x.node").alias("a"), F.greatest("centre", "x.node").alias("b")).distinct()
    more = stored(_verified(stored(_near(again, sets, percent), "near"), sets, percent), "hub_links")
    links = stored(links.unionByName(more), "links")
    labels = stored(components(links), "labels")

    # Then what is still in different components: for each component and list the closest pairs that were not compared, more
    # of them in each round, until no list has any. A list that gives none has no link left and is not looked at again.
    narrow = sets.select(F.col("print").alias("node"), F.size("items").alias("n"), "sketch")
    left, tried, most = lists, None, 1
    while True:
        rest = left.select("list_id", F.explode("members").alias("node")).join(labels, "node", "left").withColumn(
            "label", F.coalesce("label", "node"))
        split = stored(rest.groupBy("list_id").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select(
            "list_id"), "split")
        members_of = rest.join(split, "list_id", "left_semi").join(narrow, "node")
        if tried is None:
            members_of = members_of.withColumn("compared", F.lit(None).cast("array<bigint>"))
        else:
            both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
            members_of = members_of.join(both.groupBy(F.col("a").alias("node")).agg(F.collect_set("b").alias("compared")),
                                         "node", "left")
        open_lists = members_of.groupBy("list_id").agg(F.collect_list(F.struct("node", "label", "n", "sketch", "compared")).alias("m"))
        close = stored(_closest(open_lists.select(
            "list_id", F.col("m.node").alias("nodes"), F.col("m.label").alias("labels"), F.col("m.n").alias("sizes"),
            F.col("m.sketch").alias("sketches"), F.col("m.compared").alias("compared")), percent, most), "closest")
        wanted_pairs = stored(close.select("a", "b").distinct(), "late_near")
        if wanted_pairs.isEmpty():
            break
        late = stored(_verified(wanted_pairs, sets, percent), "late_links")
        if not late.isEmpty():
            links = stored(links.unionByName(late), "links")
            labels = stored(components(links), "labels")
        tried = wanted_pairs if tried is None else stored(tried.unionByName(wanted_pairs), "tried")
        left = stored(left.join(close.select("list_id").distinct(), "list_id", "left_semi"), "open")
        most *= 8

    named = classes.join(labels.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "label", F.coalesce("label", "print"))
    least = named.groupBy("label").agg(F.min(F.struct(F.col("rep_id").isNull().alias("no_id"), "rep_id")).alias("least"))
    named = stored(named.join(least, "label").select("print", F.col("least.rep_id").alias("component_id")), "named")
    return members.join(named, "print", "left").select(
        "id", "key", "n_shingles", "print",
        F.when(F.col("print") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _sets_of(spark: SparkSession, texts: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """print and items of the sets that share a signature with another one, from one document of each class."""
    ids = chosen.select(F.col("rep_id").alias("want"))
    if chosen.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    rows = texts.join(ids, texts["id"].eqNullSafe(ids["want"]), "left_semi")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in H.pieces(batch, "text"):
                items, bounds = shingle_sets(part.column("text"), n)
                sketches = [sketch(items[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_prints(items, bounds).view(np.int64), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(items.view(np.int64), pa.int64())),
                     pa.array(sketches, pa.list_(pa.int64()))],
                    ["print", "items", "sketch"])

    # Rows that repeat an id may give a set twice or one that nobody asked for; neither changes which pairs are linked.
    return rows.select("text").mapInArrow(expand, "print long, items array<long>, sketch array<long>")
