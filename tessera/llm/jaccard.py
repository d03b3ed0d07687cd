"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection.

A document's set holds its distinct word shingles (a shorter text is one
shingle, a text without words has none).  Two documents link when the Jaccard
similarity of their sets is at least ``percent`` / 100.

*Tiles.*  Sizes fall into bands, each 100 / percent times the one before, so a
partner is in the same band or the next.  A tile family joins a band with the
next.  In it sets may differ in at most ``D`` elements, so when the shingles
are dealt by hash into ``D + 1 + E`` parts, linked sets agree in at least
``E + 1`` parts.  A tile is the content of one part: documents that agree in a
non-empty part meet there.  Empty parts make no tile, unless a set has more
than ``E`` of them (then each makes one), so no link is missed; and a passage
or line that many documents share fills a whole part only in documents that
are mostly equal.

*Links, without all pairs.*  First every member of a tile is tested against the
tile's smallest doc_id; the links give components.  Only tiles that still hold
two components go on: members outside the component of the smallest doc_id are
compared with the others, in cells of bounded size, and only links that join
components come out.  A test looks at hashed bitmaps first: the bits that
differ bound the symmetric difference from below, hence the overlap from above;
pairs that pass get the exact intersection of their sorted arrays.  Every link
is inside a component or was tested.

Defined results: null texts have no set; rows with a null doc_id are linked
with nothing (null component); rows that repeat a doc_id are one node with the
links of each; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WORDS = 4
PERCENT = 85
BLOCK = 2_000


def shingle_set(data: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles (A-Z lower-cased)."""
    codes = C.word_codes(C.lower_ascii(data)) if data else np.empty(0, C.U64)
    if not len(codes):
        return codes
    return np.unique(C.mix(C.Stretches(codes).grams(min(words, len(codes)))))


class Bands:
    """Size bands and the number of parts of each tile family."""

    def __init__(self, percent: int):
        self.percent, self.start, self.parts = percent, [1], []

    def __reduce__(self):
        return Bands, (self.percent,)

    def of(self, size: int) -> int:
        while self.start[-1] <= size or len(self.parts) < len(self.start) - 1:
            if self.start[-1] <= size:
                self.start.append(max(self.start[-1] + 1, -(-self.start[-1] * 100 // self.percent)))
            if len(self.parts) < len(self.start) - 1:
                x = self.start[len(self.parts) + 1] - 1
                differ = (100 - self.percent) * (x + x * 100 // self.percent) // (100 + self.percent)
                self.parts.append((differ, 1 + differ // 16 if differ else 0))
        return int(np.searchsorted(self.start, size, "right")) - 1


def tiles(members: np.ndarray, bands: Bands) -> np.ndarray:
    """Hashes of the tiles that a set belongs to (48 bits of them are used: tiles
    that fall together only add pairs to test)."""
    if not len(members):
        return members
    band, out = bands.of(len(members)), []
    for family in range(max(0, band - 1), band + 1):
        differ, spare = bands.parts[family]
        parts = differ + 1 + spare
        salt = C.U64(family) << C.U64(40)
        part = C.mix(members ^ salt) % C.U64(parts)
        order = np.argsort(part)
        p = part[order]
        heads = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        content = np.add.reduceat(C.mix(members + C.U64(77))[order], heads)
        out.append(C.mix(content ^ C.mix(p[heads] | salt)))
        if parts - len(heads) > spare:
            empty = np.setdiff1d(np.arange(parts, dtype=C.U64), p[heads])
            out.append(C.mix(C.mix(empty | salt) + C.U64(1)))
    return np.concatenate(out)


def bitmap(members: np.ndarray) -> np.ndarray:
    """Bit ``hash mod L`` of every member; L: a power of two, at least twice the size."""
    bits = max(64, 1 << int(2 * len(members) - 1).bit_length())
    at = members & C.U64(bits - 1)
    out = np.zeros(bits // 64, C.U64)
    np.bitwise_or.at(out, (at >> C.U64(6)).astype(np.int64), C.U64(1) << (at & C.U64(63)))
    return out


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap(s) at a smaller power of two of 64-bit words."""
    return np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, words), axis=-2)


def may_link(a: int, b, overlap_bound, percent: int):
    """True unless sizes or the bound on the overlap rule a link out."""
    return ((100 * np.minimum(a, b) >= percent * np.maximum(a, b))
            & ((100 + percent) * overlap_bound >= percent * (a + b)))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """By the intersection of the sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"),
                                                   F.col("text").cast("binary").alias("text"))


def shared_tiles(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(tile, doc, leader) of tiles with two documents or more; leader: the smallest."""
    def rows(batch):
        bands = Bands(percent)
        found = [tiles(shingle_set(x, words), bands) for x in batch.column(1).to_pylist()]
        n = [len(x) for x in found]
        return {"tile": C.signed(np.concatenate(found) >> C.U64(16)), "doc": np.repeat(batch.column(0).to_numpy(), n)}

    tile = Window.partitionBy("tile")
    return (C.map_arrow(_numbered(docs), rows, "tile long, doc long")
            .withColumns({"leader": F.min("doc").over(tile), "top": F.max("doc").over(tile)})
            .where("leader < top").drop("top"))


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Sorted sets and bitmaps of the documents listed in ``wanted`` (doc)."""
    def rows(batch):
        sets = [shingle_set(x, words) for x in batch.column(1).to_pylist()]
        return {"doc": batch.column(0), "size": np.array([len(x) for x in sets], np.int64),
                "bits": pa.array([bitmap(x).tobytes() for x in sets], pa.binary()),
                "members": pa.array([x.tobytes() for x in sets], pa.binary())}

    return C.map_arrow(_numbered(docs).join(C.small_side(wanted), "doc", "left_semi"), rows,
                       "doc long, size long, bits binary, members binary")


def may_link_bits(size_a: int, size_b: int, bits_a: np.ndarray, bits_b: np.ndarray, percent: int) -> bool:
    words = min(len(bits_a), len(bits_b))
    differ = int(np.bitwise_count(folded(bits_a, words) ^ folded(bits_b, words)).sum())
    return bool(may_link(size_a, size_b, (size_a + size_b - differ) // 2, percent))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets link: bitmaps travel first, arrays for those that pass."""
    def by_bits(batch):
        cols = [batch.column(i).to_pylist() for i in range(2, 6)]
        keep = np.array([may_link_bits(na, nb, np.frombuffer(xa, C.U64), np.frombuffer(xb, C.U64), percent)
                         for na, xa, nb, xb in zip(*cols)], bool)
        return {"a": batch.column(0).to_numpy()[keep], "b": batch.column(1).to_numpy()[keep]}

    def by_members(batch):
        cols = [batch.column(i).to_pylist() for i in range(2, 4)]
        keep = np.array([linked(np.frombuffer(ma, C.U64), np.frombuffer(mb, C.U64), percent) for ma, mb in zip(*cols)],
                        bool)
        return {"a": batch.column(0).to_numpy()[keep], "b": batch.column(1).to_numpy()[keep]}

    def both(which, *columns):
        out = pairs if which is by_bits else passed
        for end in "ba":
            out = out.join(sets.select(F.col("doc").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
        return C.map_arrow(out.select("a", "b", *[f"{c}_{end}" for end in "ab" for c in columns]), which, "a long, b long")

    passed = both(by_bits, "size", "bits")
    return both(by_members, "members")


def _passing(i, others, comp, size, maps, percent):
    """Of ``others`` those in another component that bitmaps and sizes let through."""
    others = others[comp[others] != comp[i]]
    differ = np.bitwise_count(maps[i] ^ maps[others]).sum(axis=1, dtype=np.int64)
    return others[may_link(size[i], size[others], (size[i] + size[others] - differ) // 2, percent)]


def _cell(cell: pa.Table):
    """Arrays of one cell; its pairs are given as (member, array of others)."""
    own = cell["x"][0].as_py() >= 0
    minor = cell["minor"].to_numpy()
    bits = [np.frombuffer(x, C.U64) for x in cell["bits"].to_pylist()]
    words = min(map(len, bits))
    left = np.flatnonzero(minor)
    right = left if own else np.flatnonzero(~minor)
    pairs = ((i, right[right > i] if own else right) for i in left.tolist())
    return (cell["doc"].to_numpy(), cell["comp"].to_numpy().copy(), cell["size"].to_numpy(),
            np.stack([folded(x, words) for x in bits]), pairs)


def cell_near(cell: pa.Table, percent: int) -> list[tuple[int, int]]:
    """(major, doc) of members with a partner that the bitmaps let through."""
    doc, comp, size, maps, pairs = _cell(cell)
    near = np.zeros(len(doc), bool)
    for i, others in pairs:
        found = _passing(i, others, comp, size, maps, percent)
        near[found] = True
        near[i] |= len(found) > 0
    major = cell["major"][0].as_py()
    return [(major, int(d)) for d in doc[near]]


def cell_links(cell: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links between different components of one cell, enough to join them:
    once two components are joined their other pairs need no test."""
    doc, comp, size, maps, pairs = _cell(cell)
    sets, out = [np.frombuffer(x, C.U64) for x in cell["members"].to_pylist()], []
    for i, others in pairs:
        for k in _passing(i, others, comp, size, maps, percent).tolist():
            if comp[k] != comp[i] and linked(sets[i], sets[k], percent):
                out.append((int(doc[i]), int(doc[k])))
                comp[comp == comp[k]] = comp[i]
    return out


def in_cells(members: DataFrame, sets: DataFrame, block: int, fn, names: tuple[str, str], least_majors: int) -> DataFrame:
    """``fn`` over cells of a group's members (major, doc, comp, minor): its minor
    members meet the major ones, in cells of one block of these, and each
    other, in cells of two blocks; a block has about ``block`` documents.  Fewer
    than ``least_majors`` major members need no cell."""
    counts = members.groupBy("major").agg(F.sum((~F.col("minor")).cast("long")).alias("majors"),
                                          F.sum(F.col("minor").cast("long")).alias("minors"))
    counts = counts.where(f"minors > 0 and (majors >= {least_majors} or minors > 1)")
    blocks, minor_blocks = (F.ceil(F.col(c) / F.lit(block)).cast("int") for c in ("majors", "minors"))
    mine = F.pmod(F.xxhash64("doc"), blocks).cast("int")
    own = F.pmod(F.xxhash64("doc"), minor_blocks).cast("int")
    # a cell: (-1, block of the major component) or (block, block) of the others
    major_cell = F.array(F.struct(F.lit(-1).alias("x"), mine.alias("y")))
    major_cells = F.when(F.col("majors") >= least_majors, F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.lit(-1).alias("x"), k.alias("y")))).otherwise(F.array())
    minor_cells = F.when(F.col("minors") > 1, F.transform(
        F.sequence(F.lit(0), minor_blocks - 1),
        lambda k: F.struct(F.least(k, own).alias("x"), F.greatest(k, own).alias("y")))).otherwise(F.array())
    cells = F.when(F.col("minor"), F.concat(major_cells, minor_cells)).when(F.col("majors") >= least_majors, major_cell)
    payload = [c for c in sets.columns if c != "doc"]
    placed = (members.join(sets, "doc").join(counts, "major").withColumn("cell", F.explode(cells))
              .select("major", "cell.x", "cell.y", "doc", "comp", "minor", *payload)
              .repartition("major", "x", "y").sortWithinPartitions("major", "x", "y", "doc"))

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            cell = np.stack([table[c].to_numpy().astype(np.int64) for c in ("major", "x", "y")], 1)
            cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1).tolist()]
            yield emitted([x for a, b in zip(cuts, cuts[1:]) for x in one(table.slice(a, b - a))])
            held = table.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield emitted(one(held))

    def one(cell):
        return fn(cell) if cell.num_rows > 1 else []

    def emitted(out):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], list(names))

    return placed.mapInArrow(run, f"{names[0]} long, {names[1]} long")


def remaining_links(shared: DataFrame, components: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links that join the components still apart in some tile.

    Tiles whose leaders are in one (major) component are taken together, so
    a document travels once for all of them: first with its bitmap, and with
    its array only if the bitmaps leave it a partner.
    """
    labelled = (shared.join(components.select(F.col("node").alias("doc"), "component"), "doc", "left")
                .join(components.select(F.col("node").alias("leader"), F.col("component").alias("major")), "leader", "left")
                .select("tile", "doc", F.coalesce("component", "doc").alias("comp"),
                        F.coalesce("major", "leader").alias("major"))
                .withColumn("minor", F.col("comp") != F.col("major")))
    mixed = C.stored(labelled.withColumn("apart", F.max("minor").over(Window.partitionBy("tile"))).where("apart")
                     .select("major", "doc", "comp", "minor").distinct())
    # one major member alone is the leader, which all others met before
    near = in_cells(mixed, sets.select("doc", "size", "bits"), block, lambda cell: cell_near(cell, percent),
                    ("major", "doc"), 2).distinct()
    close = C.stored(mixed.join(near, ["major", "doc"], "left_semi"))
    wanted = C.small_side(close.select("doc").distinct())
    return in_cells(close, sets.join(wanted, "doc", "left_semi").select("doc", "size", "bits", "members"), block,
                    lambda cell: cell_links(cell, percent), ("a", "b"), 1)


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(node, component) of every document that has a link; component: smallest doc_id."""
    C.prepare(docs.sparkSession)
    shared = C.stored(shared_tiles(docs, words, percent))
    sets = C.stored(sets_of(docs, shared.select("doc").distinct(), words))
    tested = shared.where("doc <> leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct()
    links = C.stored(verified(tested, sets, percent))
    more = remaining_links(shared, C.connected_components(links), sets, percent, block)
    return C.connected_components(links.unionByName(more))


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """doc_id, set size and component of every document."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return with_components(docs, jaccard_components(docs), WORDS)


def with_components(docs: DataFrame, components: DataFrame, words: int) -> DataFrame:
    def rows(batch):
        return {"doc_id": batch.column(0), "n_shingles": np.array(
            [len(shingle_set(x, words)) for x in batch.column(1).to_pylist()], np.int64)}

    sizes = C.map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")),
                        rows, "doc_id long, n_shingles long")
    return (sizes.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
