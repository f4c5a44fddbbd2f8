"""Line dedup by a segment-partition edit join, in DataFrame expressions alone.

Lines are compared in a normal form (lower case, white space as single spaces, trimmed). Distinct forms enter the join once,
however often they occur. For a threshold of t edits, a form of length n is split into t + 1 segments: a form within t edits,
of length n to n + t, has one of them unchanged at one of the few places that its length allows, so it is found by a
substring index over (length, segment, substring).

Where too many forms share a segment, more is asked of them. For more than one edit the forms are split into twice as many
blocks, of which t may hold the edits: a pair agrees on the runs of blocks between any t that hold them, each run shifted
by what the edits before it insert or delete. These runs together are the finer key; every choice of t blocks and every
possible shift is indexed, so that no pair is lost, and forms that share hot keys alone go on to the next split. For one
edit, the rest of the form (the block that may hold the edit) is
split again: a pair within one edit agrees before and after the smaller block that holds the edit,
so all of a hot key's forms are dealt out again by (prefix before the block, suffix after it), level by
level, down to single characters. Pairs are made only from small keys; none are dropped.

Candidates are verified with a banded bit-parallel edit distance: the band's 2 t + 1 diagonals are
bits of one number, and a fold over the longer form's characters updates their vertical deltas.

What goes: of equal forms all but the first occurrence (by id, then place), and every occurrence of a form
within the threshold of a form that first occurs earlier. A document that loses all of its text is
marked not kept.

Defined cases: null text stays null and has no lines; lines whose form has fewer than `min_chars`
characters are not judged for edits, and those of fewer than `exact_chars` (`min_chars` if not given) not at all; rows with the same id and the same text count as one document and all keep
or lose the same lines; null ids sort first; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import math
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionloom.llm.common import components, release, safe_name, settle

#: Edits, if not given; shortest form that is judged; parts into which a hot key's block is split at a time; pairs that a key may make unsplit.
THRESHOLD, MIN_CHARS, PARTS, KEY_PAIRS = 1, 30, 4, 40
#: Most keys that a form of a hot key is indexed under before its pairs are made, for more than one edit.
FINEST_KEYS = 5_000
#: Most line keys that are broadcast (16 bytes each, about) where lines are filtered by them.
BROADCAST_KEYS = 100_000
#: Lines that stand for more than such a part of all occurrences are broadcast where occurrences meet them.
HOT_LINES = 10_000


def normal_lines(text: Column) -> Column:
    """The text's lines in their normal form. The text is normalised as a whole, and the costly pattern
    runs only where something needs it."""
    low = F.lower(text)
    odd = F.contains(low, F.lit("  ")) | F.contains(low, F.lit("\t")) | F.contains(low, F.lit("\r"))
    return F.split(F.when(odd, F.regexp_replace(low, r"[ \t\r\f\x0B]+", " ")).otherwise(low), "\n")


def edit_distance(a: Column, b: Column, threshold: int = THRESHOLD) -> Column:
    """Edit distance of a and b (length(a) <= length(b) <= length(a) + threshold) if it is within
    the threshold, else a larger number.

    Bit k of the band stands for row j - threshold + k of column j. D0 tells where a cell equals its
    upper left neighbour; the distance is read along the diagonal that ends in the last cell.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    # Rows above the first count down to it, rows below count up.
    above = (1 << threshold) - 1

    def let(value: Column, body) -> Column:
        """Names a value, so that it is worked out once."""
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def matches(s: Column, j: Column, p: Column, t: Column) -> Column:
        c, hits = F.get(t, j - 1), F.lit(0)
        for k in range(width):
            row = j - threshold + k
            hits = hits + F.when((row >= 1) & (F.get(p, F.greatest(row - 1, F.lit(0))) == c), 1 << k).otherwise(0)
        return F.struct(hits.alias("m"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"))

    def diagonals(s: Column) -> Column:
        carry = (s["m"].bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])
        d0 = carry.bitwiseOR(s["m"]).bitwiseOR(s["vn"]).bitwiseAND(F.lit(full))
        return F.struct(d0.alias("d0"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"))

    def advance(s: Column, j: Column, gap: Column) -> Column:
        hp = s["vn"].bitwiseOR(F.lit(full) - s["d0"].bitwiseOR(s["vp"]))
        hn = s["d0"].bitwiseAND(s["vp"])
        down = F.shiftright(s["d0"], 1)
        vp = hn.bitwiseOR(F.lit(full) - down.bitwiseOR(hp))
        same = F.call_function("shiftright", s["d0"], F.lit(threshold) - gap).bitwiseAND(F.lit(1))
        return F.struct(vp.alias("vp"), down.bitwiseAND(hp).alias("vn"), (s["d"] + F.when(j > gap, 1 - same).otherwise(0)).alias("d"))

    def fold(x: Column) -> Column:
        gap = x["n"] - x["m"]
        start = F.struct(F.lit(full & ~above).alias("vp"), F.lit(above).alias("vn"), gap.alias("d"))
        step = lambda s, j: let(matches(s, j, x["p"], x["t"]), lambda y: let(diagonals(y), lambda z: advance(z, j, gap)))
        return F.aggregate(F.sequence(F.lit(1), x["n"]), start, step, lambda s: s["d"])

    own = F.struct(F.split(a, "").alias("p"), F.split(b, "").alias("t"), F.length(a).alias("m"), F.length(b).alias("n"))
    return F.when(F.length(b) == 0, F.lit(0)).otherwise(let(own, fold))


def _block_key(form: Column, size: Column, n: Column, lo: Column, hi: Column) -> Column:
    """The part of a form outside the block [lo, hi) of the partition for length n, as a hash."""
    tail = n - hi
    return F.xxhash64(n, lo, hi, F.substring(form, F.lit(1), lo), F.substring(form, size - tail + 1, tail))


def _member(role: int, n: Column, lo: Column, hi: Column, key: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), n.cast("int").alias("n"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), key.alias("key"))


def _blocks(n: Column, lo: Column, hi: Column, parts: int) -> list[tuple[Column, Column]]:
    """[lo, hi) in equal parts."""
    cut = [lo + F.floor((hi - lo) * k / parts).cast("int") for k in range(parts + 1)]
    return list(zip(cut, cut[1:], strict=False))


def _first_blocks(size: Column) -> list[tuple[int, Column, Column, Column]]:
    """(role, n, lo, hi) of a form of that size: it stands in the partition for its own length (role 0) and in the
    one for forms a character shorter (role 1)."""
    return [(role, size - role, lo, hi) for role in (0, 1) for lo, hi in _blocks(size - role, F.lit(0), size - role, 2)]


def first_keys(form: Column) -> dict[str, Column]:
    """The size and the keys of a form's first blocks; a member's other parts follow from the size."""
    size = F.length(form)
    return {"size": size} | {f"key{k}": _block_key(form, size, n, lo, hi) for k, (_, n, lo, hi) in enumerate(_first_blocks(size))}


KEY_NAMES = ["size", *(f"key{k}" for k in range(4))]


def _first_members() -> Column:
    return F.array(*[_member(role, n, lo, hi, F.col(f"key{k}")) for k, (role, n, lo, hi) in enumerate(_first_blocks(F.col("size")))])


def _finer_members() -> Column:
    """The members that replace a member of a hot key: one for each part of its block."""
    size, n, lo, hi = F.length("form"), F.col("n"), F.col("lo"), F.col("hi")
    made = []
    for role in (0, 1):
        made.append(F.array(*[_member(role, n, a, b, _block_key(F.col("form"), size, n, a, b)) for a, b in _blocks(n, lo, hi, PARTS)]))
    return F.filter(F.when(F.col("role") == 0, made[0]).otherwise(made[1]), lambda m: m["hi"] > m["lo"])


def _pairs(members: DataFrame, live: DataFrame) -> DataFrame:
    """Pairs of lines under a key: both of the partition's own length, or one of them a character longer."""
    own = members.join(live.select("key"), "key")
    a = own.where("role = 0").select("key", F.col("line").alias("a"))
    b = own.select("key", F.col("line").alias("b"), "role")
    return a.join(b, "key").where("(role = 0 AND a < b) OR (role = 1 AND a != b)").select("a", "b").distinct()


def _sizes(members: DataFrame) -> DataFrame:
    own = F.sum(F.when(F.col("role") == 0, 1).otherwise(0))
    sizes = members.groupBy("key").agg(own.alias("own"), F.count(F.lit(1)).alias("all"))
    return sizes.where("own > 0 AND all > 1").withColumn("hot", F.col("own") * F.col("all") > KEY_PAIRS)


def _met(members: DataFrame) -> DataFrame:
    """Members whose key another line shares."""
    sizes = settle(_sizes(members))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_KEYS else sizes
    met = settle(members.join(sizes, "key").select(*members.columns, "hot"))
    release(met.sparkSession)
    return met


def _shifts(threshold: int) -> list[tuple[int, ...]]:
    """The shifts of the threshold + 1 agreed runs of a pair within the threshold: none for the first, the difference of
    the lengths for the last, and no more insertions and deletions in all than the threshold. No shift at all comes first."""
    made = [(0, *s) for s in product(range(-threshold, threshold + 1), repeat=threshold) if s[-1] >= 0]
    return sorted((s for s in made if sum(abs(b - a) for a, b in zip(s, s[1:], strict=False)) <= threshold), key=lambda s: [abs(x) for x in s])


def _numbers(rows) -> Column:
    return F.array(*[F.array(*[F.lit(x) for x in row]) for row in rows])


def _members_apart(threshold: int, parts: int) -> Column:
    """The members of a form that is split into so many blocks: one for each choice of the blocks that may hold the edits
    and each shift of the runs between them. A form stands with no shift (role 0) for itself."""
    size = F.length("form")

    def member(held: Column, shift: Column) -> Column:
        n = size - shift[threshold]
        cut = lambda k: F.floor(n * k / parts).cast("int")
        runs = []
        for j in range(threshold + 1):
            lo = F.lit(0) if j == 0 else cut(held[j - 1] + 1)
            hi = n if j == threshold else cut(held[j])
            runs.append(F.substring("form", lo + shift[j] + 1, hi - lo))
        moved = F.exists(shift, lambda x: x != 0)
        return F.struct(moved.cast("int").alias("role"), F.xxhash64(F.lit(parts), n, held, *runs).alias("key"))

    held, shifts = _numbers(combinations(range(parts), threshold)), _numbers(_shifts(threshold))
    return F.flatten(F.transform(held, lambda h: F.transform(shifts, lambda s: member(h, s))))


def _candidates(forms: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of lines of `forms` (line, form) that share a key: of threshold + 1 segments, then of ever more blocks
    for the lines that hot keys hold. A pair within the threshold shares a key at every level that it reaches, and reaches the
    next one unless it was found."""
    live, parts, found = forms, threshold + 1, []
    while True:
        last = math.comb(2 * parts, threshold) * len(_shifts(threshold)) > FINEST_KEYS
        members = live.select("line", F.explode(_members_apart(threshold, parts)).alias("m")).select("line", "m.*").distinct()
        met = _met(members)
        found.append(settle(_pairs(met, met.where(F.lit(last) | ~F.col("hot")).select("key").distinct())))
        hot = met.where("hot").select("line").distinct()
        if last or hot.isEmpty():
            break
        live, parts = forms.join(hot, "line", "left_semi"), 2 * parts
    pairs = found[0]
    for df in found[1:]:
        pairs = pairs.unionByName(df)
    # Forms of one length meet both ways.
    return pairs.select(F.when(F.col("a") < F.col("b"), F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("a") < F.col("b"), F.col("b")).otherwise(F.col("a")).alias("b"))


def near_pairs(lines: DataFrame, texts_of, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) between lines within the threshold; `lines` has line and, for one edit, first_keys(); texts_of(keys) gives
    (line, form)."""
    if threshold == 1:
        return _verified(*_candidates_of_one_edit(lines, texts_of), threshold)
    forms = settle(texts_of(lines.select("line")))
    return _verified(_candidates(forms, threshold), forms, threshold)


def _candidates_of_one_edit(lines: DataFrame, texts_of) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of lines that share a key, and the forms (line, form) of all of them."""
    members = lines.select("line", F.explode(_first_members()).alias("m")).select("line", "m.*")
    met = _met(members)
    forms = settle(texts_of(met.select("line").distinct()))
    found = [settle(_pairs(met, met.where("NOT hot").select("key").distinct()))]
    hot = met.where("hot")
    while not hot.isEmpty():
        # Forms that agree outside a block of one character are within an edit, or few: their key is not split further.
        done = hot.where("hi - lo <= 1")
        if not done.isEmpty():
            found.append(settle(_pairs(done, done.select("key").distinct())))
        finer = hot.where("hi - lo > 1").join(forms, "line").select("line", F.explode(_finer_members()).alias("m")).select("line", "m.*").distinct()
        met = _met(settle(finer))
        found.append(settle(_pairs(met, met.where("NOT hot").select("key").distinct())))
        hot = met.where("hot")
    pairs = found[0]
    for df in found[1:]:
        pairs = pairs.unionByName(df)
    return pairs, forms


def _verified(pairs: DataFrame, forms: DataFrame, threshold: int) -> DataFrame:
    near = pairs.distinct().join(forms.select(F.col("line").alias("a"), F.col("form").alias("fa")), "a").join(forms.select(F.col("line").alias("b"), F.col("form").alias("fb")), "b")
    shorter = F.length("fa") <= F.length("fb")
    low, high = F.when(shorter, F.col("fa")).otherwise(F.col("fb")), F.when(shorter, F.col("fb")).otherwise(F.col("fa"))
    near = near.select("a", "b", low.alias("low"), high.alias("high")).where(F.length("high") - F.length("low") <= threshold)
    return near.where(edit_distance(F.col("low"), F.col("high"), threshold) <= threshold).select("a", "b")


def _forms(texts: DataFrame, min_chars: int) -> DataFrame:
    """(id, row, at, form, line) of the judged lines; `line` tells forms apart by 128 bits."""
    each = texts.select("id", "row", F.posexplode(normal_lines(F.col("text"))).alias("at", "raw")).select("id", "row", "at", F.trim("raw").alias("form"))
    return each.where(F.length("form") >= min_chars).withColumn("line", F.struct(F.xxhash64("form").alias("h"), F.xxhash64(F.lit(9), "form").alias("g")))


def _hits(occurrences: DataFrame, judged: DataFrame, total: int) -> DataFrame:
    """Occurrences with their judged lines. Lines with more than a HOT_LINES-th of all occurrences, fewer than HOT_LINES
    by that count, are broadcast, so that no line that very many rows share lands in one task; the others are shuffled."""
    hot = F.col("n") > max(1, total // HOT_LINES)
    often = F.broadcast(judged.where(hot))
    rest = occurrences.join(often.select("line"), "line", "left_anti").join(judged.where(~hot), "line")
    return occurrences.join(often, "line").unionByName(rest)


def _without_places(text: Column, places: Column) -> Column:
    """The text without the lines at these places, in time in proportion to its lines."""
    kept = lambda own: F.transform(F.array_except(F.sequence(F.lit(0), F.size(own) - 1), places), lambda k: F.get(own, k))
    # Where no line is left, the sequence is empty and so is the text.
    return F.get(F.transform(F.array(F.split(text, "\n")), lambda own: F.array_join(kept(own), "\n")), F.lit(0))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, exact_chars: int | None = None, classes: bool = True, threshold: int = THRESHOLD) -> DataFrame:
    """The documents with repeated lines, and lines within `threshold` edits (1 at least), taken out of the text, and the columns lines, exact_dropped, near_dropped
    (counts), line_kept (false where all the text went) and, with `classes`, n_links (near links that its lines' forms have, and
    one for each line that stands elsewhere too) and class_id (the smallest id that links of lines reach from it, its own
    included; null for a null id)."""
    if threshold < 1:
        raise ValueError("the threshold is one edit at least")
    names = {n: safe_name(docs, n) for n in ("lines", "exact_dropped", "near_dropped", "line_kept", *(["n_links", "class_id"] if classes else []))}
    own_row, own_id, gone, places, left, linked, root = (safe_name(docs, f"__{n}") for n in ("row", "id", "gone", "places", "left", "links", "root"))
    row = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    lean = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), row.alias("row"), F.col(text_col).alias("text"))
    each = _forms(lean, min_chars if exact_chars is None else min(exact_chars, min_chars))
    # The first keys of one edit are few enough to go along; for more edits they are made from the distinct forms.
    own_keys = first_keys(F.col("form")) if threshold == 1 else {"size": F.length("form")}
    occurrences = settle(each.select("id", "row", "at", "line", *[c.alias(n) for n, c in own_keys.items()]))
    lines = occurrences.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row", "at")).alias("first"), F.min("id").alias("anchor"), *[F.first(n).alias(n) for n in own_keys])
    lines = settle(lines)
    total = lines.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    release(docs.sparkSession)

    def texts_of(keys: DataFrame) -> DataFrame:
        # A form is read again from the document of its first occurrence; other documents are not split again.
        places = settle(lines.select("line", "first.*").join(keys, "line", "left_semi"))
        few = places.count() <= BROADCAST_KEYS
        own = places.select("id", "row").distinct()
        again = lean.join(F.broadcast(own) if few else own, (lean["id"].eqNullSafe(own["id"])) & (lean["row"] == own["row"]), "left_semi")
        found = _forms(again, min_chars)
        return found.join(F.broadcast(places.select("line")) if few else places.select("line"), "line", "left_semi").select("line", "form").dropDuplicates(["line"])

    links = settle(near_pairs(lines.where(F.col("size") >= min_chars).select("line", *own_keys), texts_of, threshold))
    release(docs.sparkSession)
    firsts = lambda x: lines.select(F.col("line").alias(x), F.col("first").alias(f"f{x}"), F.col("anchor").alias(f"i{x}"))
    both = links.join(firsts("a"), "a").join(firsts("b"), "b")
    both = settle(both)
    ends = both.select(F.explode(F.array(F.struct(F.col("a").alias("line"), F.col("fb").alias("other")), F.struct(F.col("b").alias("line"), F.col("fa").alias("other")))).alias("e")).select("e.*")
    near = ends.groupBy("line").agg(F.count(F.lit(1)).alias("links"), F.min("other").alias("earliest"))
    judged = lines.select("line", "n", "first", "anchor").join(near, "line", "left").where("n > 1 OR links > 0")
    judged = settle(judged.select("line", "n", "first", "anchor", (F.coalesce("links", F.lit(0)) + (F.col("n") > 1).cast("int")).alias("links"), F.coalesce(F.col("earliest") < F.col("first"), F.lit(False)).alias("near")))
    hits = _hits(occurrences.select("id", "row", "at", "line"), judged, total).withColumn("dropped", F.col("near") | (F.struct("id", "row", "at") != F.col("first")))
    # Rows with the same id and text come as one group here; their places are the same, and a set holds each of them once.
    per_doc = hits.groupBy("id", "row").agg(F.collect_set(F.struct("at", "near", "dropped", "links")).alias("hits"), *([F.collect_set("anchor").alias("anchors")] if classes else []))
    taken = F.filter("hits", lambda x: x["dropped"])
    per_doc = per_doc.select(F.col("id").alias(own_id), F.col("row").alias(own_row), taken.alias(gone), F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["links"]).alias(linked), *(["anchors"] if classes else []))
    if classes:
        per_doc = settle(per_doc)
        edges = per_doc.select(F.col(own_id).alias("a"), F.explode("anchors").alias("b")).unionByName(both.select(F.col("ia").alias("a"), F.col("ib").alias("b")))
        reached = components(edges.where("a != b").distinct()).select(F.col("id").alias(own_id), F.col("root").alias(root))
        per_doc = per_doc.drop("anchors").join(reached, own_id, "left")
    again = safe_name(docs, "__row_of")
    out = docs.withColumn(again, row).join(per_doc, (F.col(id_col).eqNullSafe(F.col(own_id))) & (F.col(again) == F.col(own_row)), "left")
    changed = F.coalesce(F.size(gone) > 0, F.lit(False))
    out = out.withColumn(places, F.transform(gone, lambda x: x["at"]))
    out = out.withColumn(left, F.when(changed, _without_places(F.col(text_col), F.col(places))).otherwise(F.col(text_col)))
    count = lambda near: F.coalesce(F.size(F.filter(gone, lambda x: x["near"] == near)), F.lit(0)).cast("long")
    keep = [F.col(left).alias(c) if c.lower() == text_col.lower() else F.col(f"`{c}`") for c in docs.columns]
    found = {
        "lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n"))).cast("long"),
        "exact_dropped": F.when(changed, count(False)).otherwise(0).cast("long"),
        "near_dropped": F.when(changed, count(True)).otherwise(0).cast("long"),
        "line_kept": ~changed | (F.length(F.trim(F.col(left))) > 0),
    }
    if classes:
        found |= {"n_links": F.coalesce(linked, F.lit(0)).cast("long"), "class_id": F.coalesce(root, id_col)}
    return out.select(*keep, *[c.alias(names[n]) for n, c in found.items()])
