"""Near-duplicate detection with b-bit MinHash.

One pass over the texts makes a signature for each: the low ``BITS`` bits of its minima, packed
into long columns, and band keys of some whole minima each. Equal sets collapse to one node
first. Nodes that share a band key are candidates; how many packed lanes differ, by bit counts and
corrected for chance collisions, estimates their similarity; what may reach the threshold is confirmed on
the full shingle sets.

A band key that very many nodes share is not paired out. First each node is held against the smallest
node of its band key. Then components are formed, and only members of different components are compared:
those outside the largest component of the key against all, in blocks of bounded rows and bytes, where a
block names each link that joins two components once. So copies cost linear work, whatever their number,
and no link between components that the signatures support is left out.

A pair at a similarity of 0.85 misses all bands with a probability below 1e-6, at 0.8 below 5e-5; the
estimate is let pass four standard errors below the threshold (a loss below 1e-4).

Defined results: a null or empty text has an empty set, is linked with nothing and is its own component;
a null id is left out of links and takes the component of its text; rows of one id count as one document;
repeated rows repeat; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import durable, stored
from marketlake.llm.components import components
from marketlake.llm.shingles import WORDS_PER_SHINGLE, WordHashes, common, mixed, portions, shingle_set, shingle_sets

BITS = 4
#: lowest bit of each lane of a long
LOW = int("1" * 16, 16)
BLOCK_ROWS, BLOCK_SHINGLES = 256, 1 << 19
#: ids that may be broadcast to pick texts map-side (about 10 MB); more are joined by a shuffle
BROADCAST_IDS = 200_000
_BLOCK_BYTES = 1 << 19
#: hashes of many texts whose minima are taken together
_AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Banding:
    """How many minima a signature has, a multiple of 16, and how many bands of how many of them."""

    minima: int = 128
    bands: int = 25
    rows: int = 5

    @property
    def lanes(self) -> int:
        return self.minima * BITS // 64

    @property
    def lane_columns(self) -> list[str]:
        return [f"lane{k}" for k in range(self.lanes)]


DOCUMENTS = Banding()
_FACTORS = np.random.default_rng(7).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(shingles: np.ndarray, how: Banding) -> np.ndarray:
    factors, out = _FACTORS[:, : how.minima], np.full(how.minima, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):  # blocks stay in the processor's cache
        out = np.minimum(out, (shingles[at : at + 512, None] * factors[0] + factors[1]).min(axis=0))
    return out


def minima_of(hashes: np.ndarray, owner: np.ndarray, texts: int, how: Banding) -> np.ndarray:
    """``minima`` of many shingle sets at once, laid end to end; zeros for a text without shingles."""
    factors, out = _FACTORS[:, : how.minima], np.full((how.minima, texts), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _AT_ONCE):
        part, mine = hashes[at : at + _AT_ONCE], owner[at : at + _AT_ONCE]
        starts = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
        own = mine[starts]
        for k in range(how.minima):
            values = part * factors[0, k]
            values += factors[1, k]
            out[k, own] = np.minimum(out[k, own], np.minimum.reduceat(values, starts))
    out[:, np.bincount(owner, minlength=texts) == 0] = 0
    return out.T


def packed(low: np.ndarray, how: Banding) -> np.ndarray:
    """Low bits of the minima, 16 lanes to a long; one row of ``low`` for each text."""
    lanes = (low & np.uint64(15)).reshape(-1, how.lanes, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return np.bitwise_or.reduce(lanes, axis=2)


def band_keys(low: np.ndarray, how: Banding) -> np.ndarray:
    rows = low[:, : how.bands * how.rows].reshape(-1, how.bands, how.rows)
    keys = np.arange(1, how.bands + 1, dtype=np.uint64)
    for k in range(how.rows):
        keys = mixed(keys) + rows[:, :, k]
    return mixed(keys)


def _word_blocks(texts: pa.Array, words: WordHashes) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(number of the first text, word hashes of each text) of runs of texts with about ``_BLOCK_BYTES`` bytes."""
    for first, number in portions(texts, _BLOCK_BYTES):
        hashes, cuts = words.of_all(texts.slice(first, number))
        yield first, np.split(hashes, cuts[1:-1])


def signatures(
    docs: DataFrame, id_col: str, text_col: str, width: int, how: Banding, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(id, n, digest1, digest2, lanes..., bands, carry...), one row for each row of ``docs``."""
    lanes = how.lanes

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            sizes, digests, low = [], [], np.zeros((batch.num_rows, how.minima), np.uint64)
            for first, found in _word_blocks(batch["text"], words):
                hashes, owner = shingle_sets(found, width)
                ends = np.cumsum(np.bincount(owner, minlength=len(found)))
                sizes += np.diff(ends, prepend=0).tolist()
                raw = memoryview(hashes).cast("B")
                starts = [0, *ends[:-1].tolist()]
                digests += [xxhash.xxh3_128_digest(raw[8 * a : 8 * b]) for a, b in zip(starts, ends.tolist())]
                low[first : first + len(found)] = minima_of(hashes, owner, len(found), how)
            pair = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
            keys = np.hstack([pair, packed(low, how), band_keys(low, how)]).view(np.int64)
            columns = [batch["id"], pa.array(sizes, pa.int64())]
            columns += [pa.array(keys[:, k].copy()) for k in range(2 + lanes)]
            columns.append(pa.FixedSizeListArray.from_arrays(
                pa.array(keys[:, 2 + lanes :].reshape(-1)), how.bands).cast(pa.list_(pa.int64())))
            columns += [batch[c] for c in carry]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "n", "digest1", "digest2", *how.lane_columns, "bands", *carry]
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carry)
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    longs = ", ".join(f"{c} long" for c in ("n", "digest1", "digest2", *how.lane_columns))
    rest = "".join(f", {c} {kinds[c]}" for c in carry)
    return narrow.mapInArrow(sign, f"id {kinds['id']}, {longs}, bands array<long>{rest}")


def most_differing(threshold: float, how: Banding = DOCUMENTS) -> int:
    """Lanes that may differ for the estimate to lie within four standard errors of ``threshold``."""
    chance = 2.0**-BITS
    equal = chance + (1 - chance) * threshold
    return math.floor(how.minima * (1 - equal) + 4 * math.sqrt(how.minima * equal * (1 - equal)))


def differing(left: str, right: str, how: Banding = DOCUMENTS) -> Column:
    """Number of lanes in which two packed signatures differ."""
    total = F.lit(0)
    for name in how.lane_columns:
        bits = F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}"))
        folded = bits
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftright(bits, k))
        total = total + F.bit_count(folded.bitwiseAND(F.lit(LOW)))
    return total


def _sets(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the documents named in ``nodes``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            # a few at a time: a set of hashes is larger than its text
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [shingle_set(found, width).view(np.int64)
                        for _, block in _word_blocks(part["text"], words) for found in block]
                yield pa.RecordBatch.from_arrays(
                    [part["node"], part["digest1"], part["digest2"], pa.array(made, pa.list_(pa.int64())),
                     pa.array([[*np.frombuffer(xxhash.xxh3_128_digest(m.tobytes()), np.int64)] for m in made],
                              pa.list_(pa.int64()))],
                    names=["node", "digest1", "digest2", "shingles", "own"],
                )

    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    texts = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")).join(nodes, "node")
    kind = texts.schema["node"].dataType.simpleString()
    made = texts.select("node", "digest1", "digest2", "text").mapInArrow(
        make, f"node {kind}, digest1 long, digest2 long, shingles array<long>, own array<long>"
    )
    # rows of one id may hold other texts: the node stands for the one that was signed
    own = made.where((F.col("own")[0] == F.col("digest1")) & (F.col("own")[1] == F.col("digest2")))
    return durable(own.select("node", "shingles").dropDuplicates(["node"]))


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches, each run whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch[k].to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(ids[:, start])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            part = batch.slice(start, end - start)
            # only the last run is held for the next batch: a slice would hold its whole batch
            keep_apart = start and end == batch.num_rows
            held.append(part.take(pa.array(range(part.num_rows))) if keep_apart else part)
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _rows_of_lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        offsets, values = chunk.offsets.to_numpy(), chunk.values.to_numpy()
        out += [values[a:b] for a, b in zip(offsets, offsets[1:])]
    return out


def _candidates(group: pa.Table, threshold: float, allowed: int, how: Banding) -> Iterator[tuple[int, np.ndarray]]:
    """For each stray row of a block: the rows of the other side that the signatures support, are in
    another component, have a fitting size, and share this band key first."""
    get = lambda name: group[name].to_numpy()
    stray, node, comp, n, big = get("stray"), get("node"), get("comp"), get("n"), get("dominant")
    if stray.all() or not stray.any():
        return
    lanes = np.stack([get(c).view(np.uint64) for c in how.lane_columns], axis=1)
    bands = np.stack(_rows_of_lists(group["bands"]))
    place = int(np.flatnonzero(bands[0] == group["band"][0].as_py())[0])
    low = np.uint64(LOW)
    others = np.flatnonzero(~stray)
    for row in np.flatnonzero(stray):
        fits = (comp[others] != comp[row]) & ((comp[others] == big[row]) | (node[others] > node[row]))
        at = others[fits]
        small, large = np.minimum(n[at], n[row]), np.maximum(n[at], n[row])
        at = at[small >= threshold * large]
        if not len(at):
            continue
        bits = lanes[at] ^ lanes[row]
        for k in range(1, BITS):
            bits = bits | (lanes[at] ^ lanes[row]) >> np.uint64(k)
        at = at[np.bitwise_count(bits & low).sum(axis=1) <= allowed]
        if place and len(at):
            at = at[~(bands[at, :place] == bands[row, :place]).any(axis=1)]
        if len(at):
            yield row, at


def _blocks(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of the comparison blocks (band, s, m) of band keys whose members, without the smallest that
    all were held against, lie in more than one component."""
    comp = F.col("node")
    if labels is not None:
        members = members.join(labels, "node", "left")
        comp = F.coalesce("component", "node")
    rest = durable(members.where(F.col("node") != F.col("hub")).select("band", "node", comp.alias("comp"), "n"))
    parts = rest.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    blocks = lambda rows, shingles: F.greatest(
        F.lit(1), F.ceil(rows / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)
    ).cast("int")
    rows, shingles = F.sum("rows"), F.sum("shingles")
    mixed_bands = (
        parts.groupBy("band")
        .agg(
            F.max_by("comp", F.struct("rows", "comp")).alias("dominant"),
            blocks(rows, shingles).alias("m_blocks"),
            blocks(rows - F.max("rows"), shingles).alias("s_blocks"),
            F.count(F.lit(1)).alias("comps"),
        )
        .where(F.col("comps") > 1)
        .drop("comps")
    )
    mixed_bands = durable(mixed_bands)  # so that a key with many rows can be split in the join
    mine = durable(rest.join(mixed_bands, "band"))
    spot = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    facing = mine.withColumns(
        {"m": spot(1, F.col("m_blocks")), "s": every(F.col("s_blocks")), "stray": F.lit(False)}
    )
    strays = mine.where(F.col("comp") != F.col("dominant")).withColumns(
        {"s": spot(2, F.col("s_blocks")), "m": every(F.col("m_blocks")), "stray": F.lit(True)}
    )
    return facing.unionByName(strays).drop("m_blocks", "s_blocks")


def _together(df: DataFrame) -> DataFrame:
    return df.repartition("band", "s", "m").sortWithinPartitions("band", "s", "m")


def near_links(
    sets_of: Callable[[DataFrame], DataFrame], signed: DataFrame, percent: int, how: Banding
) -> DataFrame | None:
    """(node, component) of the nodes in components of two or more; None if there are none.

    ``signed`` has one row for each node: node, n, digest1, digest2, lanes, bands; ``sets_of`` makes
    (node, shingles) for rows of node, digest1 and digest2.
    """
    threshold = percent / 100
    allowed = most_differing(threshold, how)
    banded = signed.select("node", "n", F.explode("bands").alias("band"))
    shared = (
        banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("top"))
        .where(F.col("hub") != F.col("top")).drop("top")
    )
    members = durable(banded.join(shared, "band").select("band", "node", "n", "hub"))
    near = signed.select("node", "n", "digest1", "digest2", *how.lane_columns)
    pairs = members.where(F.col("node") != F.col("hub")).select("node", "hub").distinct()
    left, right = near.alias("x"), near.alias("y")
    close = durable(
        pairs.alias("p")
        .join(left, F.col("p.node") == F.col("x.node"))
        .join(right, F.col("p.hub") == F.col("y.node"))
        .where(
            (F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent)
            & (differing("x", "y", how) <= allowed)
        )
        .select("p.node", "p.hub")
    )
    wanted = close.select("node").unionAll(close.select(F.col("hub").alias("node"))).distinct()
    sets = sets_of(near.join(wanted, "node").select("node", "digest1", "digest2"))
    inter = F.size(F.array_intersect("x.shingles", "y.shingles"))
    either = F.size("x.shingles") + F.size("y.shingles")
    confirmed = (
        close.alias("p")
        .join(sets.alias("x"), F.col("p.node") == F.col("x.node"))
        .join(sets.alias("y"), F.col("p.hub") == F.col("y.node"))
        .where(inter.cast("long") * (100 + percent) >= either.cast("long") * percent)
        .select("p.node", "p.hub")
    )
    stars = durable(confirmed)
    labels = components(stars, "node", "hub") if stars.take(1) else None

    blocks = _blocks(members, labels).join(signed.select("node", *how.lane_columns, "bands", "digest1", "digest2"), "node")
    keys = ["band", "s", "m"]

    def supported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, keys):
            use = set()
            for row, at in _candidates(group, threshold, allowed, how):
                use.add(int(row))
                use.update(at.tolist())
            if use:
                yield from group.take(sorted(use)).combine_chunks().to_batches()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, keys):
            node, comp = group["node"].to_numpy(), group["comp"].to_numpy()
            sets_, top = _rows_of_lists(group["shingles"]), {}

            def root(c: int) -> int:
                while top.get(c, c) != c:
                    c = top[c]
                return c

            out = []
            for row, at in _candidates(group, threshold, allowed, how):
                for other in at:
                    a, b = root(comp[row]), root(comp[other])
                    if a == b:
                        continue
                    x, y = sets_[row].view(np.uint64), sets_[other].view(np.uint64)
                    both = common(x, y)
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        top[max(a, b)] = min(a, b)
                        out.append((node[row], node[other]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "hub"])

    kept = durable(_together(blocks).mapInArrow(supported, blocks.schema))
    wanted = kept.select("node", "digest1", "digest2").distinct()
    if not kept.take(1):
        return labels
    more = sets_of(wanted)
    kind = blocks.schema["node"].dataType.simpleString()
    across = durable(
        _together(kept.join(more, "node")).mapInArrow(linked, f"node {kind}, hub {kind}")
    )
    if not across.take(1):
        return labels
    if labels is not None:
        across = across.unionAll(labels.select("node", F.col("component").alias("hub")))
    return components(across, "node", "hub")


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    width: int = WORDS_PER_SHINGLE,
    how: Banding = DOCUMENTS,
    carry: tuple[str, ...] = (),
    texts_of: Callable[[DataFrame], DataFrame] | None = None,
    place: str | None = None,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, carry...), one row for each row of ``docs``. Documents whose
    sets have an intersection of ``percent`` or more of their union are linked; the component is
    named by the smallest id in it. Ids must be integers. ``texts_of`` finds the rows (``id_col``,
    ``text_col``) for ids with their ``carry`` columns, where reading ``docs`` again does not give the same ids. The
    result reads the signatures at ``place``, if one is given, which the caller may remove after use."""
    signed = stored(signatures(docs, id_col, text_col, width, how, carry), place)
    classes = durable(
        signed.where(F.col("n") > 0).groupBy("digest1", "digest2").agg(F.min("id").alias("node"))
        .where(F.col("node").isNotNull())
    )
    members = signed.join(classes, ["digest1", "digest2"], "left")
    nodes = durable(
        members.where(F.col("id") == F.col("node"))
        .select("node", "n", "digest1", "digest2", *how.lane_columns, "bands")
    )

    def sets_of(wanted: DataFrame) -> DataFrame:
        if texts_of is None:
            return _sets(docs, id_col, text_col, wanted, width)
        wanted = durable(wanted)
        places = signed.select(F.col("id").alias("node"), *carry).join(wanted.select("node"), "node")
        return _sets(texts_of(places), id_col, text_col, wanted, width)

    labels = near_links(sets_of, nodes, percent, how)
    component = F.coalesce("node", "id")
    found = members.select("id", "n", "node", *carry)
    if labels is not None:
        found = found.join(labels, "node", "left")
        component = F.coalesce("component", "node", "id")
    return found.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"), *carry,
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: the one with the smallest id, rows without an
    id last. Rows are told apart by a key of their own, so rows of one id with unlike texts stay apart,
    and no column's name can clash."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    keyed = stored(docs.select(row, F.monotonically_increasing_id().alias("key")))
    told = keyed.select("key", F.col("row")[id_col].alias("owner"), F.col("row")[text_col].alias("text"))
    found = near_components(told, "key", "text", percent, carry=("owner",))
    first = found.groupBy("component_id").agg(
        F.min(F.struct(F.col("owner").isNull().alias("none"), "owner", F.col("doc_id").alias("key"))).alias("first")
    )
    return keyed.join(first.select("first.key"), "key").select("row.*")
