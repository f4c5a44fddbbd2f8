"""Tag vectors to tag sets, tag sets to one shape, and tag sets to text."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from captionloom.functions.textops import fixed, spaced

#: The one shape: tags by descending score (ties by index), for each category.
SCORED = "array<struct<tag:string,score:double>>"
# Thresholds by category where a tag has none of its own.
DEFAULTS = {"general": 0.4, "character": 0.5, "rating": 0.4}
FEATURE_THRESHOLD, CHARACTER_THRESHOLD = 0.3, 0.85


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def above(scores: Column, threshold, start: int = 0, stop: int | None = None) -> Column:
    """Indices in [start, stop) whose score is above the threshold, in index order; a null threshold keeps none."""
    pairs = F.transform(scores, lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    inside = lambda x: (x["i"] >= start) & (F.lit(True) if stop is None else x["i"] < stop)
    return F.transform(F.filter(pairs, lambda x: inside(x) & (x["p"] > threshold)), lambda x: x["i"])


def ranked(scores: Column, thresholds: Column, members: Column) -> Column:
    """Indices among `members` whose score reaches their own threshold, by descending score, then index, as
    array<struct<i, score>>."""
    pairs = F.transform(members, lambda i: F.struct((-F.get(scores, i)).alias("key"), i.alias("i"), F.get(scores, i).alias("score")))
    kept = F.filter(pairs, lambda x: x["score"] >= F.get(thresholds, x["i"]))
    return F.transform(F.array_sort(kept), lambda x: F.struct(x["i"].alias("i"), x["score"].alias("score")))


def threshold_for(own: Column, category: Column, overrides: dict[str, float] | None = None) -> Column:
    """A tag's own threshold, else its category's (an override counts even if it is 0)."""
    table = DEFAULTS | (overrides or {})
    out = None
    for name, value in table.items():
        out = F.when(category == name, F.lit(value)) if out is None else out.when(category == name, F.lit(value))
    return F.coalesce(own, out.otherwise(DEFAULTS["general"]))


def distinct_sorted(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def prompt_tags(mode: Column, text: Column) -> Column:
    """The tags that go to the prompt: in `context` mode alone; in `parallel` mode they are only saved."""
    return F.when(mode == "context", text)


def names(scored: Column) -> Column:
    return F.transform(scored, lambda x: x["tag"])


def best(scored: Column) -> Column:
    """The tag with the highest score, the first of equals."""
    return F.get(names(scored), F.lit(0))


def all_tags(*scored: Column) -> Column:
    return F.concat(*[names(s) for s in scored])


def scores_map(*scored: Column) -> Column:
    """tag to score over all categories; of a tag in several the last category's score counts, in the place of the first."""
    def merge(pairs: Column) -> Column:
        last = lambda t: F.element_at(F.filter(pairs, lambda x: x["tag"] == t), -1)["score"]
        return F.transform(F.array_distinct(names(pairs)), lambda t: F.struct(t.alias("tag"), last(t).alias("score")))

    # A one-element array names the joined list, so that it is built once.
    return F.get(F.transform(F.array(F.concat(*scored)), merge), F.lit(0))


def rounded(scored: Column, digits: int = 4) -> Column:
    return F.transform(scored, lambda x: F.struct(x["tag"].alias("tag"), F.bround(x["score"], digits).alias("score")))


def _section(title: str, items: Column) -> Column:
    return F.when(F.size(items) > 0, F.concat(F.lit(f"{title}: "), F.array_join(F.transform(items, spaced), ", ")))


def prompt_lines(general: Column, character: Column, rating: Column) -> Column:
    """Every tag of each category that has some, one line for each."""
    return F.concat_ws("\n", _section("Features", general), _section("Characters", character), _section("Rating", rating))


def prompt_lines_best(general: Column, character: Column, rating: Column) -> Column:
    """As prompt_lines, from scored tags, with the best rating alone."""
    return F.concat_ws("\n", _section("Features", names(general)), _section("Characters", names(character)), F.when(F.size(rating) > 0, F.concat(F.lit("Rating: "), best(rating))))


def prompt_lines_series(features: Column, characters: Column, series: Column) -> Column:
    return F.concat_ws("\n", _section("Features", features), _section("Characters", characters), _section("IPs/Series", series))


def with_tags(prompt: Column, lines: Column) -> Column:
    return F.when(F.coalesce(lines, F.lit("")) == "", prompt).otherwise(F.concat(prompt, F.lit("\n\nExisting tags:\n"), lines))


def canonical(sidecar: Column) -> Column:
    """struct<general, character, rating> from the JSON of any of the three sidecar shapes: nested `tags` with
    `*_tags`, plain category lists (at the top or under `tags`), or top-level `*_tags`."""

    def pick(name: str) -> Column:
        paths = (f"$.tags.{name}_tags", f"$.{name}_tags", f"$.tags.{name}", f"$.{name}")
        return F.coalesce(*[F.from_json(F.get_json_object(sidecar, p), "array<string>") for p in paths], F.array().cast("array<string>"))

    return F.struct(*[pick(n).alias(n) for n in ("general", "character", "rating")])


def show_sections(**lists: Column) -> Column:
    """`# name` and the list, with a blank line between."""
    return F.concat_ws("\n\n", *[F.rtrim(F.concat(F.lit(f"# {n}\n"), F.array_join(c, ", "))) for n, c in lists.items()])


def show_scores(**scored: Column) -> Column:
    """`  tag: 0.123` under each category that has tags."""
    line = lambda x: F.concat(F.lit("  "), x["tag"], F.lit(": "), fixed(x["score"], 3))
    return F.concat_ws("\n\n", *[F.when(F.size(c) > 0, F.concat(F.lit(f"# {n}\n"), F.array_join(F.transform(c, line), "\n"))) for n, c in scored.items()])


def letterbox(width: Column, height: Column, to_width: int, to_height: int) -> Column:
    """Size and offset of an image that is scaled to fit a canvas and centred."""
    scale = F.least(F.lit(to_width) / width, F.lit(to_height) / height)
    w, h = F.floor(width * scale).cast("int"), F.floor(height * scale).cast("int")
    return F.struct(w.alias("width"), h.alias("height"), F.floor((to_width - w) / 2).cast("int").alias("left"), F.floor((to_height - h) / 2).cast("int").alias("top"))


def series_of(found: Column, vocabulary: dict[int, list[str]]) -> Column:
    """The distinct, sorted series of the tags found (their indices). The vocabulary is a model's, so its size is bounded;
    it stands in the plan as an array with a place for each index, and no row is shuffled."""
    last = max(vocabulary, default=-1)
    places = F.from_json(F.lit(json.dumps([vocabulary.get(i, []) for i in range(last + 1)])), "array<array<string>>")
    return F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda i: F.coalesce(F.get(places, i), F.array().cast("array<string>"))))))
