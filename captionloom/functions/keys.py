"""Ids, paths, URLs, routes and shares as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from captionloom.functions.textops import base64_plain

# File kinds.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "webp", "gif", "bmp", "tiff")
URL_SUFFIXES = ("jpg", "jpeg", "png", "gif", "webp", "bmp", "tiff", "avif")
MIME = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp"}
SPLITS = {"train": "train", "validation": "val", "test": "test"}


def image_id(split: Column, index: Column, own: Column | None = None) -> Column:
    """The row's own id made safe and without its last suffix, else the split's prefix and the index in eight digits."""
    prefix = F.when(split == "train", "train").when(split == "validation", "val").when(split == "test", "test").otherwise(split)
    numbered = F.concat(prefix, F.lit("_"), F.format_string("%08d", index.cast("long")))
    if own is None:
        return numbered
    return F.when(own.isNull(), numbered).otherwise(F.regexp_replace(F.translate(own, "/\\ ", "___"), r"\.[^.]*$", ""))


def stem(name: Column) -> Column:
    """A file name without the suffix of an image or sidecar; null for other files."""
    return F.nullif(F.regexp_extract(name, r"^(.*)(\.tag\.json|\.caption\.json|\.jpg|\.jpeg|\.png|\.webp)$", 1), F.lit(""))


def split_of(name: Column) -> Column:
    return F.when(name.startswith("train_"), "train").when(name.startswith("val_"), "val").when(name.startswith("test_"), "test").otherwise("unknown")


def route(split: Column, class_id: Column) -> Column:
    """test or class -1: `test`; train and val: `split/class`; null for unknown splits (counted, but not moved)."""
    return F.when((split == "test") | (class_id == -1), "test").when(split.isin("train", "val"), F.concat(split, F.lit("/"), class_id.cast("string")))


def is_number_name(name: Column) -> Column:
    """Whether a folder's name is a whole number (with sign, spaces around or single underscores inside)."""
    return name.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$")


def unquoted_path(url: Column) -> Column:
    """The URL's path with %XX decoded; a plus sign and a percent sign without two hex digits stay."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    whole = F.regexp_replace(path, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(whole, F.lit("+"), F.lit("%2B")))


def _last_part(url: Column) -> Column:
    return F.regexp_extract(unquoted_path(url), r"([^/]*)$", 1)


def url_suffix(url: Column) -> Column:
    """Lower-case suffix of the URL's last part if it is an image's (jpeg as jpg), else jpg."""
    found = F.lower(F.regexp_extract(_last_part(url), r"\.([^.]*)$", 1))
    return F.when(found == "jpeg", "jpg").when(found.isin(*URL_SUFFIXES), found).otherwise("jpg")


def url_file_name(url: Column, index: Column) -> Column:
    """The URL's last part made safe for a file system if it has a suffix, else the index in four digits."""
    last = _last_part(url)
    return F.when(last.contains("."), F.regexp_replace(last, r'[<>:"/\\|?*]', "_")).otherwise(F.concat(F.format_string("%04d", index.cast("long")), F.lit("."), url_suffix(url)))


def is_url(source: Column) -> Column:
    return source.startswith("http://") | source.startswith("https://")


def mime_of(path: Column, default: str = "image/png") -> Column:
    suffix, out = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1)), None
    for name, kind in MIME.items():
        out = F.when(suffix == name, kind) if out is None else out.when(suffix == name, kind)
    return out.otherwise(default)


def data_url(path: Column, content: Column, given: Column | None = None, mime: str = "image/png") -> Column:
    """A data URL of the given base64 or of the file's bytes; without either the source itself (a URL)."""
    made = F.concat(F.lit("data:"), mime_of(path, mime), F.lit(";base64,"), base64_plain(content))
    own = F.lit(None).cast("string") if given is None else given
    return F.coalesce(F.concat(F.lit(f"data:{mime};base64,"), own), made, path)


def shard_of(position: Column, shards: int) -> Column:
    """Stride shard of a 1-based position."""
    return F.pmod(position - 1, F.lit(shards)).cast("int")


def load_outcome(failed: Column, error: Column, label: Column) -> tuple[Column, Column]:
    """(error, label) of an item: where it failed to load its error and label -1, else no error and its own label."""
    failed = F.coalesce(failed, F.lit(False))
    return F.when(failed, error), F.when(failed, F.lit(-1)).otherwise(label).cast("int")


def share_of(total: Column, rank: Column, ranks: int) -> Column:
    """Rows of a rank where the total is dealt out evenly."""
    return (F.floor(total / ranks) + F.when(rank < F.pmod(total, F.lit(ranks)), 1).otherwise(0)).cast("long")


def batches_of(total: Column, size: int) -> Column:
    return F.ceil(total / size).cast("long")


def request_id() -> Column:
    """A new id for each row, of eight hex digits. A task that runs again draws new ones: settle rows before they are used twice."""
    return F.substring(F.uuid(), 1, 8)


def iso_timestamp(moment: Column) -> Column:
    """Date and time as ISO text; microseconds are there only where they are not zero."""
    micros = F.date_format(moment, "SSSSSS")
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)))


def image_kind(content: Column) -> Column:
    """The format that the first bytes of an image tell: jpeg, png, gif, webp, bmp, tiff or avif; null for others."""
    head = F.hex(F.substring(content, 1, 12))
    kind = F.when(head.startswith("FFD8FF"), "jpeg").when(head.startswith("89504E470D0A1A0A"), "png").when(head.rlike("^47494638(37|39)61"), "gif")
    kind = kind.when(head.rlike("^52494646.{8}57454250"), "webp").when(head.startswith("424D"), "bmp")
    return kind.when(head.startswith("49492A00") | head.startswith("4D4D002A"), "tiff").when(head.rlike("^.{8}6674797061766966"), "avif")
