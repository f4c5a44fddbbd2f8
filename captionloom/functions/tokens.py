"""Token counts of texts and of a caption's fields."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def word_tokens(text: Column) -> Column:
    """Runs of anything but white space; null and empty texts have none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^ \n\t\r]+"), 0)), F.lit(0)).cast("long")


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    return made


def tokenizer_counts(path: str):
    """A vectorised count with a tokenizer file that every executor can read; one tokenizer for each worker process."""

    @pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _tokenizer(path)
        for texts in batches:
            yield pd.Series([len(x) for x in own.encode_batch(texts.fillna("").tolist(), add_special_tokens=False)], dtype="int64")

    return count


def field_tokens(fields: dict[str, tuple[str, Column]], count=word_tokens) -> Column:
    """struct of counts: texts by themselves, lists as the sum over their items; other kinds are left out."""
    made = []
    for name, (kind, c) in fields.items():
        if kind == "str":
            made.append(count(c).alias(name))
        elif kind == "list":
            made.append(F.aggregate(F.coalesce(F.transform(c, count), F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, x: a + x).alias(name))
    return F.struct(*made)


def total_tokens(fields: dict[str, tuple[str, Column]], count=word_tokens) -> Column:
    counts = field_tokens(fields, count)
    names = [n for n, (kind, _) in fields.items() if kind in ("str", "list")]
    out = F.lit(0).cast("long")
    for n in names:
        out = out + counts[n]
    return out
