"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is its distinct 5-word shingles. Documents with equal sets form a class, and one
representative of each class enters the join, so exact copies never meet in pairs. The join walks
TREES independent trees. The root of each branches a document into children by BRANCHES minwise
tokens that the tree chooses; below, every node chooses its own. A node that one document reaches
is dropped; a small one is compared exhaustively by sketch, and what is alike is confirmed on full sets.

The members of a larger node bring their full sets. They are dealt into bounded blocks, each of which is compared
exhaustively, the most alike first; links confirmed on full sets make labels, and pairs under one label are not compared
any more, so a large group of near copies costs about one link for each of them and not a pair for each two. A node
of one block or of one label is done. Where few members are outside a node's most frequent label, these are
compared with all members, dealt into blocks, and the node is done too; the others branch on, and after LEVELS levels are
finished in the same way, in blocks of both sides. No member of a node is left out. The components of all
confirmed links are found by alternating stars.

A pair at exactly the threshold misses all TREES * BRANCHES root children with probability
0.25 ** 8, about 2e-5, and the screen by sketches with 2e-5. Only in nodes with more than BLOCK labels does it
need deeper levels, where one shared child is expected at each.

Defined cases: null, empty and wordless texts have an empty set and link with nothing; a text of
fewer than five words has its whole sequence as its one shingle; of a component, the document with
the smallest id stays; documents that share a null id never link; repeated rows with the same id get the
same component; an empty table gives no rows; further columns are ignored by near_dedup.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionloom.llm.common import components, few, release, settle, ship, sliced

WORDS, NUMERATOR, DENOMINATOR = 5, 75, 100
#: Minwise tokens of a sketch; trees; children of a document in a tree's root.
SKETCH, TREES, BRANCHES = 64, 4, 2
#: Of 100 documents of a deeper node, those that get a second child: one child over the threshold each, on average, so that
#: the paths of a pair at the threshold do not die out and those of less similar documents do.
SECOND = 33
#: Members up to which a root's child is compared by sketches; members, and tokens of their sets, that one block holds about.
SMALL, BLOCK, BLOCK_TOKENS = 48, 1024, 1_000_000
#: Members outside its most frequent label with which a node is finished (whatever their tokens, if they are FEW); levels after
#: which every node is; members of each block, and of each node, that meet all.
MOST_LONE, FEW, LEVELS, HUBS = 2048, 8, 16, 16
#: Bits of a block's shared tokens (in 64s) up to which its sets are compared as bits, without the screen by sketches.
MOST_LINES = 256
#: Equal sketch places (of SKETCH) that make a pair a candidate (4.3 standard errors below the threshold).
MAYBE = 33
#: Pairs for which a hub's set is sent once.
HUB_PAIRS = 64

_rng = np.random.default_rng(20_240_229)
_MIX = (_rng.integers(0, 2**63, WORDS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_PERM_A = (_rng.integers(0, 2**63, SKETCH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_PERM_B = _rng.integers(0, 2**63, SKETCH, dtype=np.uint64)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the text's distinct shingles (bytes.lower() changes A-Z alone)."""
    own = (text or "").encode().lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    if len(own) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(own), seed=1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    n = len(h) - words + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(words):
        mixed += _scramble(h[k : k + n] * _MIX[k] + np.uint64(k))
    return np.unique(_scramble(mixed))


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """SKETCH minwise tokens for each (not empty) set, as rows of 32-bit numbers."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), SKETCH), np.uint32)
    for k in range(SKETCH):
        out[:, k] = np.minimum.reduceat((flat * _PERM_A[k] + _PERM_B[k]) >> np.uint64(32), starts)
    return out


def _prints(id_type: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            made = iter(sketch(full).view(np.int32)) if full else iter(())
            rows = [next(made) if len(s) else None for s in sets]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.list_(pa.int32()))],
                names=["id", "n", "key", "sketch"],
            )

    return run


def _agree(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Equal places of every two rows of two arrays of sketches."""
    out = np.zeros((len(own), len(other)), np.int16)
    for k in range(SKETCH):
        out += own[:, k, None] == other[None, :, k]
    return out


def _linked(p: np.ndarray, q: np.ndarray) -> bool:
    both = len(np.intersect1d(p, q, assume_unique=True))
    return DENOMINATOR * both >= NUMERATOR * (len(p) + len(q) - both)


def _bits(rows: list[np.ndarray], most: int) -> np.ndarray | None:
    """The rows' sets as bits of the tokens that two rows share at least, a line of numbers for each 64 of these tokens;
    None if there were more than `most` lines."""
    at = np.unique(np.concatenate(rows), return_inverse=True)[1]
    often = np.bincount(at) > 1
    lines = max(1, -(-int(often.sum()) // 64))
    if lines > most:
        return None
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])[often[at]]
    at = (np.cumsum(often) - 1)[at[often[at]]]
    out = np.zeros((lines, len(rows)), np.uint64)
    np.bitwise_or.at(out, (at // 64, row), np.uint64(1) << (at % 64).astype(np.uint64))
    return out


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, SKETCH)


def _small_nodes(rows: DataFrame, id_type: str) -> DataFrame:
    """Pairs (a, b), similar by sketch and under different labels, of members (tree, node, id, label, sketch) of small nodes."""

    def compare(table: pa.Table) -> pa.RecordBatch:
        node = table.column("node").to_numpy()
        tree = table.column("tree").to_numpy()
        label = np.unique(np.array(table.column("label").to_pylist(), object).astype(str), return_inverse=True)[1]
        own, left, right = _sketches(table.column("sketch")), [], []
        for step in range(1, SMALL):
            at = np.flatnonzero((node[step:] == node[:-step]) & (tree[step:] == tree[:-step]))
            if not len(at):
                break
            at = at[label[at] != label[at + step]]
            at = at[(own[at] == own[at + step]).sum(axis=1) >= MAYBE]
            left.append(at)
            right.append(at + step)
        ids = table.column("id").to_pylist()
        ends = [(min(ids[x], ids[y]), max(ids[x], ids[y])) for x, y in zip(np.concatenate([[], *left]).astype(int), np.concatenate([[], *right]).astype(int), strict=True)]
        kind = table.schema.field("id").type
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in ends], kind), pa.array([b for _, b in ends], kind)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            # The last node may go on in the next batch.
            node = table.column("node").to_numpy()
            tree = table.column("tree").to_numpy()
            same = (node == node[-1]) & (tree == tree[-1])
            cut = len(node) - int(same.sum())
            yield compare(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None:
            yield compare(rest)

    return rows.repartition("tree", "node").sortWithinPartitions("tree", "node").mapInArrow(run, f"a {id_type}, b {id_type}").distinct()


def _block_links(rows: DataFrame, id_type: str, hubs: bool = False) -> DataFrame:
    """In every group (tree, node, i, j) of (id, label, lone, full), each row with `lone` is compared with all others under
    another label, and labels that a confirmed link joins become one. What comes out joins the members of each such
    label to one of them, (a, b); with `hubs` also (tree, node, b, degree), the HUBS members that link with most that no
    other hub links with."""

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        ids, names = group.column("id").to_pylist(), group.column("label").to_pylist()
        number = {n: k for k, n in enumerate(dict.fromkeys(names))}
        label, whole = np.array([number[n] for n in names]), [np.frombuffer(x, np.uint64) for x in group.column("full").to_pylist()]
        size, lone = np.array([len(x) for x in whole]), group.column("lone").to_numpy(zero_copy_only=False)
        bits = _bits(whole, MOST_LINES)
        own = np.concatenate([sketch(whole[lo : lo + 64]) for lo in range(0, len(whole), 64)]) if bits is None else None
        first, left, right = np.flatnonzero(lone), [], []
        for lo in range(0, len(first), 64):
            part = first[lo : lo + 64]
            if bits is None:
                fit = _agree(own[part], own) >= MAYBE
            else:
                both = np.zeros((len(part), len(ids)), np.int64)
                for line in bits:
                    if line[part].any():
                        both += np.bitwise_count(line[part][:, None] & line[None, :])
                fit = DENOMINATOR * both >= NUMERATOR * (size[part][:, None] + size[None, :] - both)
            # Two rows with `lone` meet once.
            fit &= (label[part][:, None] != label[None, :]) & ~(lone[None, :] & (np.arange(len(ids))[None, :] < part[:, None]))
            x, y = np.nonzero(fit)
            left.append(part[x])
            right.append(y)
        left, right = (np.concatenate([np.zeros(0, int), *x]) for x in (left, right))
        root, degree = list(range(len(number))), np.bincount(np.concatenate([left, right]), minlength=len(ids))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        # Pairs of well linked rows come first, so that few others have to be looked at.
        order = np.argsort(-(degree[left] + degree[right]), kind="stable") if bits is None else slice(None)
        for x, y in zip(left[order].tolist(), right[order].tolist(), strict=True):
            p, q = find(label[x]), find(label[y])
            if p != q and (bits is not None or _linked(whole[x], whole[y])):
                root[max(p, q)] = min(p, q)
        names = list(number)
        rows = [(names[find(x)], names[x], None) for x in range(len(names)) if find(x) != x]
        if hubs and len(left):
            links = np.lexsort((right, left))
            left, right = left[links], right[links]
            free = np.ones(len(ids), bool)
            for _ in range(HUBS):
                use = free[left] & free[right]
                degree = np.bincount(np.concatenate([left[use], right[use]]), minlength=len(ids))
                top = int(degree.argmax())
                if not degree[top]:
                    break
                rows.append((None, ids[top], int(degree[top])))
                free[right[left == top]] = free[left[right == top]] = free[top] = False
        kind = group.schema.field("id").type
        tree, node = key[0].as_py(), key[1].as_py()
        at = [pa.array([tree] * len(rows), pa.int32()), pa.array([node] * len(rows), pa.int64())]
        return pa.Table.from_arrays([*at, pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())], names=["tree", "node", "a", "b", "degree"])

    rows = rows.select("tree", "node", "i", "j", "id", "label", "lone", "full")
    return rows.groupBy("tree", "node", "i", "j").applyInArrow(compare, f"tree int, node long, a {id_type}, b {id_type}, degree long")


def _children(rows: DataFrame, id_type: str) -> DataFrame:
    """The children of (tree, node, id, n, full). Every node chooses two minwise tokens of its own; the second one itself
    decides whether it gives a child, alike for all documents that share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            at, keys = [], []
            seeds = _scramble(batch.column("node").to_numpy().view(np.uint64) * _MIX[0] + batch.column("tree").to_numpy().astype(np.uint64))
            for k, full in enumerate(batch.column("full").to_pylist()):
                tokens = np.frombuffer(full, np.uint64)
                for second in (0, 1):
                    seed = _scramble(seeds[k : k + 1] + _MIX[1 + second])
                    child = _scramble(_scramble(tokens ^ seed).min(keepdims=True) * _MIX[3] + seed)
                    if not second or int(_scramble(child)[0]) % 100 < SECOND:
                        at.append(k)
                        keys.append(child[0])
            own = batch.select(["tree", "id", "n"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array(np.array(keys, np.uint64).view(np.int64)), own.column(1), own.column(2)], names=["tree", "node", "id", "n"])

    return rows.select("tree", "node", "id", "n", "full").mapInArrow(run, f"tree int, node long, id {id_type}, n long")


def _blocks(size: str, tokens: str) -> Column:
    return F.greatest(F.ceil(F.col(size) / BLOCK), F.ceil(F.col(tokens) / BLOCK_TOKENS), F.lit(1)).cast("int")


def _labelled(rows: DataFrame, labels: DataFrame | None, count: int) -> DataFrame:
    """With the label of each id: the smallest id that confirmed links join to it."""
    if labels is None:
        return rows.withColumn("label", F.col("id"))
    return rows.join(few(labels, count), "id", "left").withColumn("label", F.coalesce("root", "id")).drop("root")


def _mixed(rows: DataFrame) -> DataFrame:
    """(tree, node, size, tokens, major, lone, lone_tokens) of the nodes with more than one label: how many members are not
    under the most frequent label, `major`, and the tokens of their sets."""
    by_label = rows.groupBy("tree", "node", "label").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("own"))
    most = F.max(F.struct("members", "own", "label")).alias("most")
    nodes = by_label.groupBy("tree", "node").agg(F.sum("members").alias("size"), F.sum("own").alias("tokens"), most)
    nodes = nodes.select("tree", "node", "size", "tokens", F.col("most.label").alias("major"), (F.col("size") - F.col("most.members")).alias("lone"), (F.col("tokens") - F.col("most.own")).alias("lone_tokens"))
    return nodes.where("lone > 0")


def _across(rows: DataFrame, lone: DataFrame) -> DataFrame:
    """Groups in which blocks of all members (with `across`) meet blocks of the `lone` ones (with `down` and `across`)."""
    each = lambda c: F.explode(F.sequence(F.lit(0), c - 1))
    # Members stand in their block of the first kind, once for each block of the second kind, and the lone ones likewise.
    whole = rows.withColumns({"i": F.pmod(F.xxhash64("id", "node"), F.col("across")).cast("int"), "lone": F.lit(False)}).withColumn("j", each(F.col("down")))
    part = lone.withColumns({"j": F.pmod(F.xxhash64("node", "id"), F.col("down")).cast("int"), "lone": F.lit(True)}).withColumn("i", each(F.col("across")))
    names = ["tree", "node", "i", "j", "id", "label", "lone", "full"]
    return whole.select(*names).unionByName(part.select(*names))


def _large_nodes(rows: DataFrame, texts: DataFrame, id_type: str) -> DataFrame | None:
    """Labels (id, root) that confirmed links give the members (tree, node, id, n) of large nodes.

    At each level a node's members are dealt into blocks, and each block is compared exhaustively; a node of one block is
    done. In the others, the blocks' best linked members meet all members. With the labels that all links so far give,
    nodes of one label are done, those with few members outside their most frequent label are
    kept to be finished by comparing these with all members, and the rest branches on.
    """
    rows = settle(rows)
    sets = _sets(settle(rows.select("id").distinct()), texts, id_type)
    labels, count, rest = None, 0, []

    def with_sets(df: DataFrame, members: int) -> DataFrame:
        # Few rows go to the sets, so that sets are moved to their blocks only.
        return sets.join(few(df, members), "id")

    def joined(found: list[DataFrame]) -> tuple[DataFrame, int]:
        new = components(_union([df.where("a IS NOT NULL").select("a", "b") for df in found]).distinct())
        if labels is not None:
            # Links join labels; ids follow their labels.
            moved = labels.join(new.select(F.col("id").alias("root"), F.col("root").alias("to")), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
            new = moved.unionByName(new.join(labels.select("id"), "id", "left_anti"))
        new = settle(new)
        return new, new.count()

    for level in range(1, LEVELS + 1):
        own = _labelled(rows, labels, count)
        nodes = settle(_mixed(own))
        n, members = nodes.agg(F.count(F.lit(1)), F.sum("size")).first()
        if not n:
            break
        own = settle(own.join(few(nodes, n), ["tree", "node"]).withColumn("across", _blocks("size", "tokens")))
        dealt = own.withColumns({"i": F.pmod(F.xxhash64("id", "node"), F.col("across")).cast("int"), "j": F.lit(0), "lone": F.lit(True)})
        links = [settle(_block_links(with_sets(dealt, members), id_type, hubs=True))]
        wide = own.where("across > 1")
        if not wide.isEmpty():
            place = F.row_number().over(Window.partitionBy("tree", "node").orderBy(F.desc("degree"), "b"))
            best = links[0].where("degree > 0").withColumn("place", place).where(F.col("place") <= HUBS).select("tree", "node", F.col("b").alias("id"))
            hubs = wide.join(few(best, HUBS * n), ["tree", "node", "id"], "left_semi").withColumn("down", F.lit(1))
            met = _across(with_sets(wide.withColumn("down", F.lit(1)), members), with_sets(hubs, HUBS * n))
            links.append(settle(_block_links(met, id_type)))
        labels, count = joined(links)
        if len(links) == 1:
            break
        left = _labelled(wide.select("tree", "node", "id", "n"), labels, count)
        nodes = settle(_mixed(left))
        n = nodes.count()
        if not n:
            break
        left = settle(left.join(few(nodes, n), ["tree", "node"]))
        last = (F.col("lone") <= MOST_LONE) & (F.col("lone_tokens") <= BLOCK_TOKENS) | (F.col("lone") <= FEW) | F.lit(level == LEVELS)
        rest.append(left.where(last).select("tree", "node", "id", "n"))
        rows = settle(_children(with_sets(left.where(~last), members), id_type))
        release(rows.sparkSession)
    if rest:
        rows = _labelled(_union(rest), labels, count)
        nodes = settle(_mixed(rows))
        n, members = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        rows = rows.join(few(nodes, n), ["tree", "node"]).withColumns({"across": _blocks("size", "tokens"), "down": _blocks("lone", "lone_tokens")})
        rows = with_sets(rows, members)
        labels, count = joined([settle(_block_links(_across(rows, rows.where("label != major")), id_type))])
    return labels


def _links(classes: DataFrame, texts: DataFrame, id_type: str) -> DataFrame:
    """Pairs (a, b), a < b, of class representatives (id, n, sketch), that have the components of the confirmed links."""
    trees = classes.select(F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "id", "n", "sketch")
    # The trees' roots have places of the sketch of their own.
    tokens = [F.xxhash64("tree", F.lit(k), F.element_at("sketch", F.col("tree") * BRANCHES + (k + 1))) for k in range(BRANCHES)]
    rows = trees.select("tree", F.explode(F.array(*tokens)).alias("node"), "id", "n")
    sizes = settle(rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    nodes, large = sizes.agg(F.count(F.lit(1)), F.count_if(F.col("size") > SMALL)).first()
    live = settle(rows.join(few(sizes, nodes), ["tree", "node"]))
    labels = _large_nodes(live.where(F.col("size") > SMALL).drop("size"), texts, id_type) if large else None
    count = labels.count() if labels is not None else 0
    small = live.where(F.col("size") <= SMALL).select("tree", "node", "id").join(classes.select("id", "sketch"), "id")
    pairs = settle(_small_nodes(_labelled(small, labels, count), id_type))
    ids = settle(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    found = _confirmed(pairs, _sets(ids, texts, id_type), id_type)
    return found if labels is None else found.unionByName(labels.where("id != root").select(F.col("root").alias("a"), F.col("id").alias("b")))


def _union(dfs: list[DataFrame]) -> DataFrame | None:
    out = None
    for df in dfs:
        out = df if out is None else out.unionByName(df)
    return out


def _sets(ids: DataFrame, texts: DataFrame, id_type: str) -> DataFrame:
    """(id, full): the full sets of the texts with these (settled) ids."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["id", "full"])

    return settle(texts.join(few(ids, ids.count()), "id", "left_semi").mapInArrow(full, f"id {id_type}, full binary"))


def _confirmed(pairs: DataFrame, sets: DataFrame, id_type: str) -> DataFrame:
    """Pairs whose full sets meet the threshold."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ok = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                ok.append(_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    # The end with more pairs is the hub; its set is sent once for each HUB_PAIRS of them, so that a leader's pairs spread.
    degree = settle(pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).groupBy("id").agg(F.count(F.lit(1)).alias("degree")))
    rows = degree.count()
    ends = pairs.join(few(degree.select(F.col("id").alias("a"), F.col("degree").alias("da")), rows), "a").join(few(degree.select(F.col("id").alias("b"), F.col("degree").alias("db")), rows), "b")
    hub = F.col("da") >= F.col("db")
    ends = ends.select(F.when(hub, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(hub, F.col("b")).otherwise(F.col("a")).alias("spoke"), F.greatest("da", "db").alias("degree"))
    spread = F.ceil(F.col("degree") / HUB_PAIRS).cast("int")
    ends = settle(ends.withColumn("salt", F.pmod(F.xxhash64("spoke"), spread)).select("hub", "spoke", "salt"))
    hubs = ends.select("hub", "salt").distinct().join(sets.select(F.col("id").alias("hub"), F.col("full").alias("left")), "hub")
    met = ends.join(sets.select(F.col("id").alias("spoke"), F.col("full").alias("right")), "spoke").join(hubs, ["hub", "salt"])
    return met.select(F.least("hub", "spoke").alias("a"), F.greatest("hub", "spoke").alias("b"), "left", "right").mapInArrow(judge, f"a {id_type}, b {id_type}")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id, n_shingles, component_id, kept."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    prints = settle(texts.mapInArrow(_prints(id_type), f"id {id_type}, n long, key binary, sketch array<int>"))
    named = prints.where("n > 0 AND id IS NOT NULL")
    classes = settle(named.groupBy("key").agg(F.min(F.struct("id", "n", "sketch")).alias("rep"), F.count(F.lit(1)).alias("rows")).select("key", "rep.id", "rep.n", "rep.sketch", "rows"))
    # An id may come with several texts; its rows are one document of the graph.
    twice = named.groupBy("id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("id")
    several = named.join(twice, "id", "left_semi").select("id", "key").distinct().join(classes.select("key", F.col("id").alias("rep")), "key").select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b"))
    found = _links(classes.select("id", "n", "sketch").dropDuplicates(["id"]), texts, id_type)
    links = settle(several.unionByName(found).distinct())
    roots = classes.select("key", "id", "rows").withColumn("root", F.col("id"))
    if not links.isEmpty():
        roots = classes.select("key", "id", "rows").join(components(links), "id", "left").withColumn("root", F.coalesce("root", "id"))
    # Documents alone in their class and component need no partner; a hot class's rows are narrow, and its
    # partition is split by the skew join as it runs.
    roots = roots.where((F.col("rows") > 1) | (F.col("root") != F.col("id"))).select("key", "root")
    out = prints.select("id", "n", "key").join(roots, "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
