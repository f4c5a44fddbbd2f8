import json
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from captionloom.functions import keys
from captionloom.functions.tags import canonical
from captionloom.operators import audits, joins, rates
from captionloom.sources import downloads, images, items
from captionloom.streaming import files


def png(path, pixels):
    """Writes an RGB or RGBA image."""
    h, w, c = pixels.shape
    raw = b"".join(b"\0" + pixels[y].tobytes() for y in range(h))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {3: 2, 4: 6}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_scan_items(spark, tmp_path):
    for name in ("a/x.jpg", "a/b/x.Png", "a-b/x.webp", "a/x.tag.json", "note.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    rows = items.in_path_order(items.scan_items(spark, str(tmp_path))).collect()
    assert [r.image_id for r in rows] == ["a/b/x", "a/x", "a-b/x"]
    assert rows[1].tag_path.endswith("/a/x.tag.json")
    assert items.scan_files(spark, str(tmp_path), ("txt",)).count() == 1


def test_sidecars_and_lists(spark, tmp_path):
    (tmp_path / "i.tag.json").write_text(json.dumps({"general": ["a"], "error": None}))
    (tmp_path / "j.tag.json").write_text("{broken")
    (tmp_path / "k.tag.json").write_text('{"tags": {"general_tags": ["b"], "rating_tags": ["s"]}}')
    rows = items.read_sidecars(spark, str(tmp_path)).select("image_id", canonical(F.col("json")).alias("t"), audits.has_key(F.col("json"), "error").alias("e")).orderBy("image_id").collect()
    assert [(r.image_id, r.t.general, r.t.rating, r.e) for r in rows] == [("i", ["a"], [], True), ("k", ["b"], ["s"], False)]
    typed = items.read_sidecars(spark, str(tmp_path), schema="general array<string>").orderBy("image_id").collect()
    assert [(r.image_id, r.general) for r in typed] == [("i", ["a"]), ("k", None)]
    (tmp_path / "u.txt").write_text("# c\n\n http://a/1 \nhttp://a/2\n")
    assert [(r.file, r.position, r.url) for r in items.read_url_lists(spark, str(tmp_path)).orderBy("position").collect()] == [("u.txt", 1, "http://a/1"), ("u.txt", 2, "http://a/2")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a/x", True, 1), ("b", False, 2), ("c", None, 3)], "image_id string, success boolean, class_id int")
    items.write_results(df, f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out/captions").count() == 1 and spark.read.parquet(f"{tmp_path}/out/failed").count() == 2
    items.write_routed(df, f"{tmp_path}/routed", "class_id")
    assert sorted(p.name for p in (tmp_path / "routed").iterdir() if p.is_dir()) == ["class_id=1", "class_id=2", "class_id=3"]
    items.write_item_files(df, f"{tmp_path}/files")
    assert json.loads((tmp_path / "files/a/x.caption.json").read_text()) == {"image_id": "a/x", "success": True, "class_id": 1}
    items.append_log(spark.createDataFrame([("r", "m", True, 1.5, 0)], "request_id string, model string, success boolean, latency_ms double, retries int"), f"{tmp_path}/log")
    items.append_log(spark.createDataFrame([("s", "m", False, 2.5, 1)], "request_id string, model string, success boolean, latency_ms double, retries int"), f"{tmp_path}/log")
    log = items.read_request_log(spark, f"{tmp_path}/log")
    row = audits.request_stats(log.groupBy(), F.col("success"), F.col("latency_ms"), F.col("retries")).first()
    assert (row.requests, row.average_latency_ms, row.mean_latency_ms) == (2, 4.0, 2.0)
    empty = audits.request_stats(log.limit(0).groupBy(), F.col("success"), F.col("latency_ms"), F.col("retries")).first()
    assert (empty.requests, empty.success_rate, empty.average_latency_ms) == (0, 0.0, 0.0)


def test_images(spark, tmp_path):
    rgb = np.array([[[255, 0, 10], [0, 255, 20]]], np.uint8)
    rgba = np.array([[[255, 0, 0, 0], [10, 20, 30, 255]]], np.uint8)
    png(tmp_path / "a.png", rgb)
    png(tmp_path / "b.png", rgba)
    (tmp_path / "c.jpg").write_bytes(b"not an image")
    found = images.read_images(spark, str(tmp_path))
    files_ = items.scan_files(spark, str(tmp_path)).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    joined = images.with_load_errors(files_, found).orderBy("path").collect()
    assert [r.error for r in joined] == [None, None, "cannot decode image"]
    flat = found.orderBy("path").select(images.flatten_rgb("data", "width", "height", "channels").alias("p")).collect()
    assert list(flat[0].p) == rgb.ravel().tolist() and list(flat[1].p) == [255, 255, 255, 10, 20, 30]
    steps = [{"type": "pad_to_size", "width": 4, "height": 4}, {"type": "to_tensor"}, {"type": "odd"}, {"type": "normalize", "mean": [0.5] * 3, "std": [0.5] * 3}]
    tensor = np.array(found.orderBy("path").select(images.tensors(steps)("data", "width", "height", "channels").alias("t")).first().t).reshape(4, 4, 3)
    assert tensor.shape == (4, 4, 3) and np.allclose(tensor[0], 1.0) and np.allclose(tensor[1:3, 0], [[1, -1, 10 / 127.5 - 1]] * 2, atol=1e-5)


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("image_id"), (F.col("id") % 3 != 0).alias("ok"))
    df.repartition(5).write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        stream = files.read_stream(spark, f"{tmp_path}/in", "image_id long, ok boolean", files_at_once=2)
        files.process(stream, f"{tmp_path}/out", f"{tmp_path}/check", lambda b: b.withColumn("success", F.col("ok"))).awaitTermination()
    done, failed = spark.read.parquet(f"{tmp_path}/out/captions"), spark.read.parquet(f"{tmp_path}/out/failed")
    assert sorted(r.image_id for r in done.collect()) == [k for k in range(50) if k % 3]
    assert failed.count() == 17


def test_rates(spark):
    ticks = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"), (3, "2024-01-01 00:00:04")], "k int, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = [r.rate for r in rates.speed(ticks.withColumn("run", F.lit(1)), "ts", "k", by=("run",)).orderBy("k").collect()]
    assert got == [0.0, 0.0, 0.5]
    eta = spark.range(1).select(rates.eta(F.lit(10), F.lit(0.0)).alias("a"), rates.eta(F.lit(10), F.lit(1.0)).alias("b"), rates.eta(F.lit(90), F.lit(1.0)).alias("c"), rates.eta(F.lit(9000), F.lit(1.0)).alias("d")).first()
    assert tuple(eta) == ("?", "10s", "1.5m", "2.5h")
    numbered = rates.positions(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")), "x")
    assert all(r.position == r.x + 1 for r in numbered.collect())


def test_first_present(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "image_id int")
    a, b = spark.createDataFrame([(1, None)], "image_id int, v string"), spark.createDataFrame([(1, "b1"), (2, "b2")], "image_id int, v string")
    got = {r.image_id: (r.v, r.source) for r in joins.first_present(ids, "image_id", "v", a, b).collect()}
    assert got == {1: (None, 0), 2: ("b2", 1), 3: (None, None)}


def test_repeated_keys_multiply_nothing(spark):
    ids = spark.createDataFrame([(1,), (2,)], "image_id int")
    a = spark.createDataFrame([(1, "y", None), (1, "x", None), (2, "z", "bad")], "image_id int, v string, error string")
    assert sorted((r.image_id, r.v) for r in joins.attach_tags(ids, a).collect()) == [(1, "x"), (2, None)]
    assert [r.v for r in joins.with_class(ids, a.select("image_id", "v"), "image_id").orderBy("image_id").collect()] == ["x", "z"]
    assert joins.first_present(ids, "image_id", "v", a.select("image_id", "v")).count() == 2


def test_vocabularies_and_row_places(spark, tmp_path):
    (tmp_path / "map.json").write_text('{"tag_map": {"a": 0, "null": 1, "c": 2}, "tag_split": {"gen_tag_count": 2, "other": 1}}')
    got = sorted(tuple(r) for r in items.read_tag_map(spark, str(tmp_path / "map.json")).collect())
    assert got == [(0, "a", "general"), (1, "null", "general"), (2, "c", "character")]
    (tmp_path / "tags.csv").write_text('id,name,category\n9,nan,0\n8,"x, y",4\n7,null,9\n')
    (tmp_path / "categories.json").write_text('[{"category": 0, "name": "general"}, {"category": 4, "name": "character"}]')
    got = sorted(tuple(r) for r in items.read_tag_table(spark, str(tmp_path / "tags.csv"), str(tmp_path / "categories.json")).collect())
    assert got == [(0, "nan", "general"), (1, "x, y", "character"), (2, "null", None)]
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/rows/{k}")
    rows = items.read_dataset_rows(spark, f"{tmp_path}/rows/*", "id").collect()
    assert sorted(r.id for r in rows) == list(range(30)) and all(r["index"] == r.id for r in rows)


def test_downloads(spark, tmp_path):
    def fetch(url):
        if "bad" in url:
            raise OSError("no such image")
        return url.encode()

    urls = spark.createDataFrame([("a.txt", 1, "http://h/x.png"), ("a.txt", 2, "http://h/bad.gif"), ("b.txt", 1, "http://h/y"), ("b.txt", 2, None)], "file string, position long, url string")
    seen = lambda: {(r.file, r.position): (r["name"], r.success, r.existed, r.error) for r in downloads.download(urls, str(tmp_path), fetch=fetch).collect()}
    first = seen()
    assert first[("a.txt", 1)] == ("0001.png", True, False, None) and first[("b.txt", 1)] == ("0001.jpg", True, False, None)
    assert first[("a.txt", 2)] == ("0002.gif", False, False, "http://h/bad.gif: no such image") and first[("b.txt", 2)][3] == "no URL"
    assert (tmp_path / "a" / "0001.png").read_bytes() == b"http://h/x.png" and sorted(p.name for p in tmp_path.rglob("*.*")) == ["0001.jpg", "0001.png"]
    assert seen()[("a.txt", 1)] == ("0001.png", True, True, None)
    assert downloads.download(urls.limit(0), str(tmp_path), fetch=fetch).count() == 0
    named = downloads.download(urls, str(tmp_path / "o"), original_names=True, fetch=fetch).collect()
    assert {r["name"] for r in named if r.success} == {"x.png", "0001.jpg"}


def test_image_content(spark, tmp_path):
    import base64

    (tmp_path / "i.png").write_bytes(b"\x89PNG\r\n\x1a\n....")
    text = base64.b64encode(b"\xff\xd8\xff0").decode()
    rows = [(1, text, None), (2, "data:image/jpeg;base64," + text, "http://h/x"), (3, None, str(tmp_path / "i.png")), (4, None, "http://h/x"), (5, None, "/none.png"), (6, None, None)]
    df = spark.createDataFrame(rows, "i int, b string, s string")
    got = df.select("i", downloads.image_content(F.col("b"), F.col("s"), lambda u: b"GIF89a" + u.encode()).alias("r")).select("i", "r.*", keys.image_kind(F.col("r.content")).alias("kind")).orderBy("i").collect()
    assert [r.kind for r in got] == ["jpeg", "jpeg", "png", "gif", None, None]
    assert [r.error is None for r in got] == [True, True, True, True, False, False] and got[5].error == "no image"


def test_repair_files_and_quick_items(spark, tmp_path):
    rows = spark.createDataFrame([("a", 7.0, 0.1, 0.2), ("b", 0.5, 0.1, None), ("c", 11.0, 0.0, 0.0)], "image_id string, aesthetic_score double, nsfw_score double, quality_score double")
    assert items.repair_files(rows, str(tmp_path), dry_run=True) == 1 and not list(tmp_path.iterdir())
    assert items.repair_files(rows, str(tmp_path)) == 1 and [p.name for p in tmp_path.iterdir()] == ["a.caption.json"]
    assert json.loads((tmp_path / "a.caption.json").read_text())["aesthetic_score"] == 0.7
    assert items.quick_items(rows, 2).count() == 2 and items.quick_items(rows, None).count() == 3
    assert items.has_any(rows) and not items.has_any(rows.limit(0))


def test_request_ids(spark):
    ids = [r.i for r in spark.range(50).select(keys.request_id().alias("i")).collect()]
    assert len(set(ids)) == 50 and all(len(i) == 8 and int(i, 16) >= 0 for i in ids)


def test_medians_of_large_groups(spark):
    import random
    import statistics

    rng = random.Random(3)
    rows = [(g, h, v) for g, h, n, spots in (("a", 1, 3001, 10**9), ("a", None, 2000, 5), (None, 1, 1500, 300), ("b", 2, 2, 9), ("c", 3, 0, 1)) for v in (rng.randrange(spots) / 7 for _ in range(n))]
    rows += [("c", 3, None), ("b", 2, None), *[("d", 4, 1.5)] * 1200]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(5)
    got = {(r.g, r.h): r for r in audits.spread_by(df, "g", "h", gathered=50, v=F.col("v"), w=-F.col("v")).collect()}
    plain = {(r.g, r.h): r for r in audits.spread(df.groupBy("g", "h"), v=F.col("v"), w=-F.col("v")).collect()}
    assert len(got) == 6 == len(plain)
    for key, r in got.items():
        own = [v for g, h, v in rows if (g, h) == key and v is not None]
        assert r.v_count == len(own) and r.v_median == (statistics.median(own) if own else None)
        assert (r.w_median, r.v_min, r.w_max) == (plain[key].w_median, plain[key].v_min, plain[key].w_max)
    assert audits.spread_by(df.limit(0), "g", v=F.col("v")).count() == 0
