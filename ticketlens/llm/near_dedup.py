"""Near duplicates by a chosen-path similarity join over word shingles.

A document's set is that of its distinct shingles, hashed to 64 bits. Equal sets meet first and go on as one
representative. Each representative has minhashes. Several trees, each with minhashes of its own,
branch the representatives: a node picks one or two positions by its own hash, and a document
goes to the child that its minhash there names. A child per 1 / 0.8 of the positions on average keeps a
pair at the threshold together with a chance that does not fade with depth. Nodes that are small are
leaves; large ones branch again, until none is large or they no longer shrink. What stays large is dealt into
leaves that all share one member.

In a leaf, a byte of each of 256 minhashes estimates the similarity of every pair. The leaf hands out a
spanning forest of its likely pairs; these are confirmed on the full sets, and the confirmed links give
components. Where likely pairs still join different components, the full sets of just those members come to the
leaf, which compares them all there and hands out the links that join components. So a group of copies costs pairs
in proportion to its size, never to its square, and no likely link goes unchecked unless its ends are joined already.

Groups of copies are linked before the trees branch: representatives that agree in two minhashes meet in
leaves of a fixed size, and the components these give are known from then on. A node whose members all belong
to one component is dropped, so that the members of a large group are not carried down every tree.

What dealing has not joined in a large node is then compared in full: members outside the node's largest
component meet every other member, in leaves for each pair of blocks, spread over tasks. These rows
grow with the product of the two sides, so with the square of a large node whose members are not alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.arrowtext import LOWER, flat, runs, words
from ticketlens.llm.components import components
from ticketlens.llm.scratch import Scratch

WIDTH = 5
#: Pairs are linked when SHARE per cent or more of their union is common.
SHARE = 80
SKETCH = 256
TREES = 12
#: Minhashes that each tree has for itself.
OWN = 16
HASHES = TREES * OWN
#: Pairs of minhashes by which copies meet before the trees.
KEYS = 4
#: Large nodes branch again as long as that leaves less than this part of their rows in large nodes.
SHRINK = 0.8
#: Largest node that is compared in full, and the size that last large nodes are dealt into.
LEAF = 64
DEALT = 512
#: Pairs are confirmed when the estimate is at least this, four deviations below the threshold.
LIKELY = 0.7
_COLUMNS = 8192
_SECOND = 0.25  # chance of a second position: 1.25 children on average, 1 / 0.8

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers (the splitmix64 finaliser, whose constants are fixed values)."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULTIPLY = mix(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
_FLIP = mix(np.arange(1001, 1001 + SKETCH, dtype=np.uint64))


def shingles(column: pa.Array, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; A-Z count as a-z.

    A text of fewer words than ``width`` has one shingle, its whole sequence; one without words none.
    """
    data, starts = flat(column)
    codes, distinct, bounds = words(LOWER[data], starts)
    of_word = np.fromiter(
        (xxhash.xxh3_64_intdigest(word) for word in distinct.to_pylist()), np.uint64, len(distinct)
    )
    hashes = of_word[codes]
    size = len(hashes) - width + 1
    rolled = np.full(max(size, 0), np.uint64(width))
    for k in range(width if size > 0 else 0):
        rolled = mix(rolled * _GOLD + hashes[k : k + size])
    out = []
    for at, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - at >= width:
            out.append(np.unique(rolled[at : end - width + 1]))
        elif end > at:
            whole = np.array([np.uint64(end - at)])
            for one in hashes[at:end]:
                whole = mix(whole * _GOLD + one)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minhashes (32 bits) per set; empty sets have zeros."""
    out = np.zeros((len(sets), SKETCH), np.uint32)
    filled = [n for n, one in enumerate(sets) if len(one)]
    if not filled:
        return out
    every = np.concatenate([sets[n] for n in filled])
    starts = np.cumsum([0, *(len(sets[n]) for n in filled[:-1])])
    for k in range(SKETCH):
        least = np.minimum.reduceat((every ^ _FLIP[k]) * _MULTIPLY[k], starts)
        out[filled, k] = (least >> np.uint64(32)).astype(np.uint32)
    return out


def _signatures(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            sets = shingles(batch.column("text"), width)
            hashes = minhashes(sets).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(one.tobytes()) for one in sets], pa.binary()),
                    pa.array([row[:HASHES].tobytes() for row in hashes], pa.binary()),
                    pa.array([row.astype(np.uint8).tobytes() for row in hashes], pa.binary()),
                ],
                names=["doc_id", "text_key", "n_shingles", "set_key", "minhashes", "sketch"],
            )

    return sign


_TREE = np.uint64(63)  # a node's low bits name its tree


def _positions(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first position a node branches by, whether it takes a second, and that one; all of its own tree."""
    base = (nodes & _TREE) * np.uint64(OWN)
    first = mix(nodes ^ np.uint64(0xA5A5)) % np.uint64(OWN)
    second = mix(nodes ^ np.uint64(0x5A5A)) % np.uint64(OWN - 1)
    second = (first + np.uint64(1) + second) % np.uint64(OWN)
    two = mix(nodes ^ np.uint64(0xC3C3)) < np.uint64(int(_SECOND * 2**64))
    return (base + first) % np.uint64(HASHES), two, (base + second) % np.uint64(HASHES)


def _children(rows: np.ndarray, nodes: np.ndarray, hashes: np.ndarray):
    """Rows and nodes of the next level."""
    first, two, second = _positions(nodes)
    each = np.arange(len(rows))
    out_rows, out_nodes = [], []
    for position, chosen in ((first, slice(None)), (second, two)):
        at = position[chosen].astype(np.int64)
        value = hashes[each[chosen], at].astype(np.uint64)
        child = mix(nodes[chosen] * _GOLD + (position[chosen] << np.uint64(32)) + value)
        out_rows.append(rows[chosen])
        out_nodes.append((child & ~_TREE) | (nodes[chosen] & _TREE))
    return np.concatenate(out_rows), np.concatenate(out_nodes)


def _hash_rows(batch: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(batch.column("minhashes").to_pylist())
    return np.frombuffer(raw, "<u4").reshape(-1, HASHES)


def _branch(trees: int | None):
    """Children of the roots of all trees, or of the node that each row is in."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            hashes = _hash_rows(batch)
            if trees is None:
                found = [_children(rows, batch.column("node").to_numpy().astype(np.uint64), hashes)]
            else:
                found = []
                for tree in range(trees):
                    root = (mix(np.full(len(rows), tree + 7, np.uint64)) & ~_TREE) | np.uint64(tree)
                    found.append(_children(rows, root, hashes))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([r for r, _ in found])),
                    pa.array(np.concatenate([n for _, n in found]).astype(np.int64)),
                ],
                names=["row", "node"],
            )

    return branch


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys by which copies meet: each is made of two minhashes."""
    for batch in batches:
        rows, hashes = batch.column("row").to_numpy(), _hash_rows(batch).astype(np.uint64)
        keys = [
            mix(mix(hashes[:, k * OWN] + np.uint64(k)) * _GOLD + hashes[:, k * OWN + 1]) for k in range(KEYS)
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(rows, KEYS)), pa.array(np.concatenate(keys).astype(np.int64))], names=["row", "node"]
        )


def _sized(members: DataFrame) -> DataFrame:
    """Members of the nodes that hold two components at least, with the node's size and one of its rows."""
    sizes = members.groupBy("node").agg(
        F.count("*").alias("size"),
        F.min("row").alias("pivot"),
        (F.min("root") < F.max("root")).alias("mixed"),
    )
    return members.join(sizes.where("mixed").drop("mixed"), "node")


def _dealt(large: DataFrame, size: int) -> DataFrame:
    """Columns leaf and row: large nodes dealt into leaves of about ``size`` that share the node's pivot."""
    part = F.pmod(F.xxhash64("row", "node"), F.ceil(F.col("size") / size))
    dealt = large.select(F.xxhash64("node", part).alias("leaf"), "row", "pivot")
    around = dealt.select("leaf", F.col("pivot").alias("row")).distinct()
    return dealt.select("leaf", "row").unionByName(around).distinct()


def _leaves(
    scratch: Scratch, reps: DataFrame, roots: DataFrame, trees: int, levels: int | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The members of every leaf of every tree, of the leaves that large last nodes are dealt into
    (columns leaf and row), and of these nodes themselves (node and row)."""
    hashes = reps.select("row", "minhashes")
    members = hashes.mapInArrow(_branch(trees), "row long, node long")
    leaves, level, before = [], 1, None
    while True:
        sized = scratch.write(_sized(_with_root(members, roots)), f"sized-{level}")
        leaves.append(sized.where(F.col("size") <= LEAF).select(F.col("node").alias("leaf"), "row"))
        large = sized.where(F.col("size") > LEAF)
        now = large.count()
        if not now or level == levels or (before is not None and now > SHRINK * before):
            break
        level, before = level + 1, now
        members = large.select("row", "node").join(hashes, "row")
        members = members.mapInArrow(_branch(None), "row long, node long").distinct()
    every = leaves[0]
    for more in leaves[1:]:
        every = every.unionByName(more)
    return (
        scratch.write(every, "leaves"),
        scratch.write(_dealt(large, DEALT), "dealt"),
        scratch.write(large.select("node", "row"), "large"),
    )


def _with_root(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the component they are known to be in: their own row at first."""
    return members.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row"))


def _blocks(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Columns leaf and row: leaves in which all members of a large node meet that are not joined yet."""
    members = _with_root(large, roots)
    counted = members.groupBy("node", "root").agg(F.count("*").alias("n"))
    nodes = counted.groupBy("node").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("size")
    )
    nodes = nodes.where("size > most.n").select(
        "node",
        F.col("most.root").alias("main"),
        F.ceil(F.col("most.n") / DEALT).alias("mains"),
        F.ceil((F.col("size") - F.col("most.n")) / DEALT).alias("rests"),
    )
    members = members.join(nodes, "node").withColumn("rest", F.col("root") != F.col("main"))
    hashed, own = F.xxhash64("row", "node"), F.col("own")
    members = members.withColumn(
        "own", F.when(F.col("rest"), F.pmod(hashed, "rests")).otherwise(F.pmod(hashed, "mains"))
    )
    rests, mains = (F.sequence(F.lit(0).cast("long"), F.col(n) - 1) for n in ("rests", "mains"))

    def leaf(one: Column, two: Column, both: bool) -> Column:
        return F.xxhash64(F.col("node"), one, two, F.lit(both))

    # a block of the rest meets itself in its leaves with the largest component
    others = F.filter(rests, lambda k: k != own)
    met = F.when(
        F.col("rest"),
        F.concat(
            F.transform(mains, lambda k: leaf(own, k, False)),
            F.transform(others, lambda k: leaf(F.least(own, k), F.greatest(own, k), True)),
        ),
    ).otherwise(F.transform(rests, lambda k: leaf(k, own, False)))
    return members.select(F.explode(met).alias("leaf"), "row")


def _forest(close: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest of the likely pairs (estimates, 0 where unlikely)."""
    n, edges = len(close), []
    best, source = np.zeros(n, close.dtype), np.full(n, -1)
    waiting = np.ones(n, bool)
    for _ in range(n):
        at = int(np.where(waiting, best, -1).argmax())
        waiting[at] = False
        if source[at] >= 0 and best[at] > 0:
            edges.append((int(source[at]), at))
        nearer = waiting & (close[at] > best)
        best[nearer], source[nearer] = close[at][nearer], at
    return edges


def _likely(leaf: dict[str, np.ndarray], share: int) -> np.ndarray:
    """Estimates of the pairs that may be links between different components, 0 for all others."""
    sketches, sizes, roots = leaf["sketch"], leaf["n_shingles"], leaf["root"]
    close = np.zeros((len(roots), len(roots)), np.float32)
    _, of, counts = np.unique(roots, return_inverse=True, return_counts=True)
    for n in np.flatnonzero(of != counts.argmax()):  # members of the largest component are joined
        close[n] = close[:, n] = (sketches == sketches[n]).mean(axis=1)
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    close[(close < LIKELY) | (100 * small < share * large)] = 0
    close[roots[:, None] == roots[None, :]] = 0
    return close


def _spanning(leaf: dict[str, np.ndarray], share: int) -> list[tuple[int, int, bool]]:
    """A forest of the likely pairs, and whether it leaves out any."""
    close = _likely(leaf, share)
    pairs, rows = _forest(close), leaf["row"]
    more = int(np.count_nonzero(close)) // 2 > len(pairs)
    return [(int(rows[a]), int(rows[b]), more) for a, b in pairs]


def _open(leaf: dict[str, np.ndarray], share: int) -> list[tuple[int]]:
    """Members with a likely pair that joins different components."""
    return [(int(row),) for row in leaf["row"][_likely(leaf, share).any(axis=1)]]


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sets share: a product of their incidence matrix with itself.

    Shingles of one set alone are left out. Columns are taken in slices, and counts are exact in 32-bit floats.
    """
    n = len(sets)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(one) for one in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.append(True, every[1:] != every[:-1])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    column = np.cumsum(np.append(True, column[1:] != column[:-1])) - 1 if len(column) else column
    out = np.zeros((n, n), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for begin in range(0, width, _COLUMNS):
        a, b = np.searchsorted(column, (begin, begin + _COLUMNS))
        held = np.zeros((n, min(_COLUMNS, width - begin)), np.float32)
        held[owner[a:b], column[a:b] - begin] = 1
        out += held @ held.T
    return out.astype(np.int64)


def _linked(leaf: dict[str, np.ndarray], share: int) -> list[tuple[int, int]]:
    """Links between different components, found on the full sets, that join them without a circle."""
    close, rows, sizes = _likely(leaf, share), leaf["row"], leaf["n_shingles"]
    at = np.flatnonzero(close.any(axis=1))
    if not len(at):
        return []
    close, rows, sizes, roots = close[np.ix_(at, at)], rows[at], sizes[at], leaf["root"][at]
    common = _common([np.frombuffer(leaf["shingles"][k], "<u8") for k in at])
    good = 100 * common >= share * (sizes[:, None] + sizes[None, :] - common)
    pairs = _forest(np.where(good & (close > 0), close, 0))
    # members of one component may be joined by it alone: the forest of components is what is asked for
    root = {r: r for r in roots.tolist()}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for a, b in pairs:
        up, down = find(int(roots[a])), find(int(roots[b]))
        if up != down:
            root[up] = down
            found.append((int(rows[a]), int(rows[b])))
    return found


def _per_leaf(work, share: int, names: list[str]):
    """Runs ``work`` on the members of each leaf, from rows that are sorted by leaf."""

    def columns(table: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {n: table.column(n).to_numpy() for n in ("row", "n_shingles", "root")}
        raw = b"".join(table.column("sketch").to_pylist())
        out["sketch"] = np.frombuffer(raw, np.uint8).reshape(-1, SKETCH)
        if "shingles" in table.schema.names:
            out["shingles"] = np.array([*table.column("shingles").to_pylist(), None], object)[:-1]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in _ended(batches):
            if batch is not None:
                held.append(batch)
                leaf = batch.column("leaf")
                if not batch.num_rows or leaf[0] == leaf[-1]:
                    continue  # the leaf may go on; its parts are joined once
            if not held:
                continue
            table = pa.concat_batches(held)
            leaf = table.column("leaf").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            held = []
            if batch is not None:
                held = [table.slice(bounds[-2])]
                bounds = bounds[:-1]
            every, found = columns(table), []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                order = a + np.argsort(every["row"][a:b])
                members = {name: values[order] for name, values in every.items()}
                found += [(int(leaf[a]), *one) for one in work(members, share)]
            if found:
                fields = [pa.array(list(values)) for values in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(fields, names=["leaf", *names])

    return run


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _confirm(share: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, two in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                one, two = (np.frombuffer(x.as_buffer(), "<u8") for x in (one, two))
                common = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * common >= share * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())],
                names=["a", "b", "good"],
            )

    return confirm


def _full_sets(width: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            sets = shingles(batch.column("text"), width)
            full = [one.astype("<u8").tobytes() for one in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(full, pa.binary())], names=["row", "shingles"]
            )

    return build


class _Sets:
    """Full sets of the representatives that pairs ask for, made from the texts once each."""

    def __init__(self, scratch: Scratch, docs: DataFrame, reps: DataFrame, width: int):
        self.scratch, self.width, self.parts = scratch, width, []
        self.texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
        self.reps = reps.select("row", "doc_id", "text_key")

    def of(self, wanted: DataFrame) -> DataFrame:
        """Columns row and shingles for the rows in ``wanted``, and maybe for others."""
        for part in self.parts:
            wanted = wanted.join(part, "row", "left_anti")
        keys = wanted.join(self.reps, "row").withColumn("known", F.col("doc_id").isNotNull())
        keys = keys.select("row", "text_key", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "known")
        texts = self.texts.select(
            F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
            F.col("doc_id").isNotNull().alias("known"),
            "text_key",
            "text",
        )
        found = texts.join(keys, ["doc_id", "known", "text_key"]).select("row", "text")
        built = found.mapInArrow(_full_sets(self.width), "row long, shingles binary")
        self.parts.append(
            self.scratch.write(built.dropDuplicates(["row"]), f"sets-{len(self.parts)}")
        )
        every = self.parts[0]
        for part in self.parts[1:]:
            every = every.unionByName(part)
        return every


def link(
    docs: DataFrame,
    width: int = WIDTH,
    share: int = SHARE,
    trees: int = TREES,
    levels: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, component_id, kept.

    text_key is a 64-bit hash of the text, NULL hashing to the seed. component_id is the smallest doc_id of the
    rows that links reach. ``levels`` limits how often nodes branch. A NULL or empty text, and one of alone, has no shingles and is linked with nothing: it is its own component. Texts
    with equal sets, so also repeated rows, are linked. One row of each component is kept, that with the smallest
    doc_id. A NULL doc_id counts as larger than any other. An empty table gives an empty result;
    other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "near-dedup")
    asked = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    signed = asked.mapInArrow(
        _signatures(width),
        "doc_id long, text_key long, n_shingles long, set_key binary, minhashes binary, sketch binary",
    )
    signed = scratch.write(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    # equal sets go on as one row, whatever their number: folded in the map task, then met by key
    first = signed.where("n_shingles > 0").groupBy("set_key").agg(F.min("row").alias("row"))
    reps = signed.join(first.select("row"), "row").select(
        "row", "doc_id", "text_key", "n_shingles", "set_key", "minhashes", "sketch"
    )
    reps = scratch.write(reps, "representatives")
    sketches = reps.select("row", "n_shingles", "sketch")
    sets = _Sets(scratch, docs, reps, width)

    def in_leaves(members: DataFrame, work, fields: dict[str, str]) -> DataFrame:
        schema = ", ".join(f"{name} {kind}" for name, kind in {"leaf": "long", **fields}.items())
        rows = members.repartition("leaf").sortWithinPartitions("leaf")
        return rows.mapInArrow(_per_leaf(work, share, list(fields)), schema)

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
        full = sets.of(ends)
        checked = (
            pairs.join(full.select(F.col("row").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(full.select(F.col("row").alias("b"), F.col("shingles").alias("set_b")), "b")
            .select("a", "b", "set_a", "set_b")
            .mapInArrow(_confirm(share), "a long, b long, good boolean")
        )
        return scratch.write(checked.where("good").select("a", "b"), name)

    def placed(members: DataFrame, roots: DataFrame) -> DataFrame:
        return _with_root(members.join(sketches, "row"), roots)

    def spanned(members: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        fields = {"a": "long", "b": "long", "more": "boolean"}
        forest = scratch.write(in_leaves(members, _spanning, fields), f"{name}forest")
        return forest, confirmed(forest.select("a", "b").distinct(), f"{name}links")

    def opened(members: DataFrame, name: str) -> DataFrame | None:
        asked = scratch.write(in_leaves(members, _open, {"row": "long"}), f"{name}open")
        if asked.isEmpty():
            return None
        full = sets.of(asked.select("row").distinct())
        members = asked.join(members, ["leaf", "row"]).join(full, "row")
        found = in_leaves(members, _linked, {"a": "long", "b": "long"})
        return scratch.write(found.select("a", "b").distinct(), f"{name}more-links")

    def joined(roots: DataFrame, more: DataFrame | None, name: str) -> DataFrame:
        """Components of those known and of more links between them."""
        if more is None or more.isEmpty():
            return roots
        known = roots.select(F.col("row").alias("a"), F.col("root").alias("b"))
        return scratch.write(components(scratch, known.unionByName(more), f"{name}stars"), f"{name}roots")

    # copies first: groups of them are known by their component from then on
    own = reps.select("row", F.col("row").alias("root"))
    met = reps.select("row", "minhashes").mapInArrow(_meet, "row long, node long")
    met = scratch.write(_sized(met.withColumn("root", F.col("row"))), "met")
    _, more = spanned(_dealt(met, LEAF).join(sketches.join(own, "row"), "row"), "first-")
    roots = joined(own.limit(0), more, "first-")

    leaves, dealt, large = _leaves(scratch, reps, roots, trees, levels)
    forest, more = spanned(placed(leaves.unionByName(dealt), roots), "")
    roots = joined(roots, more, "")
    open_leaves = forest.where("more").select("leaf").distinct()
    if not open_leaves.isEmpty():
        more = opened(placed(leaves.join(open_leaves, "leaf", "left_semi"), roots), "")
        roots = joined(roots, more, "more-")
    blocks = scratch.write(_blocks(large, roots), "blocks")
    if not blocks.isEmpty():
        _, more = spanned(placed(blocks, roots), "block-")
        roots = joined(roots, more, "block-")
        blocks = scratch.write(_blocks(large, roots), "open-blocks")
        roots = joined(roots, opened(placed(blocks, roots), "block-"), "last-")
    return _classes(signed, reps, roots)


def drop_near(docs: DataFrame, width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component.

    Of rows that agree in doc_id and text, that with the smallest hash of all columns stays. Rows without
    shingles (NULL, empty and blank texts) all stay, and an empty table stays empty.
    """
    kept = link(docs, width, share).where("kept")
    name = F.concat_ws(":", F.col("text_key").cast("string"), F.col("doc_id").cast("string"))
    kept = kept.select(name.alias("__key")).groupBy("__key").agg(F.count("*").alias("__stay"))
    own = F.concat_ws(":", F.xxhash64("text").cast("string"), F.col("doc_id").cast("string"))
    rows = docs.select(F.struct(*docs.columns).alias("__row"), own.alias("__key")).join(kept, "__key")
    # rows that agree in doc_id and text stand for each other: as many stay as were kept of them
    order = Window.partitionBy("__key").orderBy(F.md5(F.to_json("__row")))
    rows = rows.withColumn("__n", F.row_number().over(order))
    return rows.where("__n <= __stay").select("__row.*")


def _classes(signed: DataFrame, reps: DataFrame, roots: DataFrame) -> DataFrame:
    """Each row with the smallest doc_id of its component."""
    known = reps.select("set_key", F.col("row").alias("rep"))
    known = known.join(roots.withColumnRenamed("row", "rep"), "rep", "left")
    known = known.withColumn("root", F.coalesce("root", "rep"))
    # folded per set first: a set with very many copies reaches the join as one row
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    best = signed.where("n_shingles > 0").groupBy("set_key").agg(F.min(order).alias("best"))
    best = best.join(known, "set_key")
    least = best.groupBy("root").agg(F.min("best").alias("least"))
    of_set = best.join(least, "root").select("set_key", "least")
    filled = signed.where("n_shingles > 0").join(of_set, "set_key")
    empty = signed.where("n_shingles = 0").withColumn("least", order)
    columns = (
        "doc_id",
        "text_key",
        "n_shingles",
        F.col("least.doc_id").alias("component_id"),
        (F.col("least.row") == F.col("row")).alias("kept"),
    )
    return filled.select(*columns).unionByName(empty.select(*columns))
