"""Images behind URLs, in base64 or in files: fetched by the workers, side by side, with an error as a row's result."""

from __future__ import annotations

import base64
import os
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from captionloom.functions import keys

Fetch = Callable[[str], bytes]


def fetch_url(url: str, timeout: float = 30.0) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "Mozilla/5.0"}), timeout=timeout) as answer:
        return answer.read()


def download(urls: DataFrame, folder: str, original_names: bool = False, concurrency: int = 5, batch: int = 64, fetch: Fetch = fetch_url) -> DataFrame:
    """(file, position, url) to the same with name, success, existed and error; images go to `folder/<file without suffix>/`,
    on a file system that all executors share.

    A file that is there already is a success and is not fetched. Images are written beside and renamed, so a task that
    runs again finds whole files and counts them as existing. URLs that give one name share a file: the last to end stays.
    At most `batch` images are under way in a task, `concurrency` at a time. A null URL is a row's error.
    """
    name = keys.url_file_name(F.col("url"), F.col("position")) if original_names else F.concat(F.format_string("%04d", "position"), F.lit("."), keys.url_suffix(F.col("url")))
    rows = urls.withColumn("name", name).withColumn("__dir", F.regexp_replace("file", r"\.[^./]*$", ""))

    def one(url: str | None, place: str, name: str | None) -> tuple[bool, bool, str | None]:
        if url is None or name is None:
            return False, False, "no URL"
        target = os.path.join(folder, place, name)
        if os.path.exists(target):
            return True, True, None
        try:
            content = fetch(url)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            own = f"{target}.{os.getpid()}.{abs(hash(url))}"
            with open(own, "wb") as f:
                f.write(content)
            os.replace(own, target)
        except Exception as e:  # a failed download is the row's result
            return False, False, f"{url}: {e}"
        return True, False, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as pool:
            for whole in batches:
                for lo in range(0, len(whole), batch):
                    part = whole.iloc[lo : lo + batch]
                    made = list(pool.map(one, *[part[c].astype(object).where(part[c].notna(), None) for c in ("url", "__dir", "name")]))
                    ok, there, errors = zip(*made, strict=True)
                    yield part.drop(columns="__dir").assign(success=list(ok), existed=list(there), error=list(errors))

    added = [T.StructField("success", T.BooleanType()), T.StructField("existed", T.BooleanType()), T.StructField("error", T.StringType())]
    return rows.mapInPandas(run, T.StructType([*rows.drop("__dir").schema.fields, *added]))


def image_content(inline: Column, source: Column, fetch: Fetch = fetch_url) -> Column:
    """struct<content, error>: the bytes of base64 text (a data URL's header is cut off) where there is some, else of the
    source, an http(s) URL or a path that the worker can open."""

    def one(inline: str | None, source: str | None) -> tuple[bytes | None, str | None]:
        try:
            if inline:
                return base64.b64decode(inline.split(",", 1)[-1]), None
            if not source:
                return None, "no image"
            if source.startswith(("http://", "https://")):
                return fetch(source), None
            with open(source.removeprefix("file:"), "rb") as f:
                return f.read(), None
        except Exception as e:  # an image that cannot be read is the row's error
            return None, str(e) or type(e).__name__

    @pandas_udf("content binary, error string")
    def run(inline: pd.Series, source: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(i, s) for i, s in zip(inline, source, strict=True)], columns=["content", "error"])

    return run(inline, source)
