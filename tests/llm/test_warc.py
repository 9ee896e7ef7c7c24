import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from clickloom.llm import captureindex, warc

PAGES = "page_id long, url string, html string, id long, file string, payload string"


def plain(rows, min_bytes):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and len(raw) >= min_bytes]
        ids = [p for p in same if p is not None]
        last = max(ids) if ids else None
        repeats = bool(same) and page != last
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if repeats else "response", last if repeats else None))
    return out


def pages():
    rows = [(i, f"https://www.Site{i % 7}.example.org/p/{i % 11}?q={i % 3}#top", f"<p>{i % 40}é</p>") for i in range(300)]
    rows += [(1000 + i, "http://hot.example/", "same " * 50) for i in range(150)]
    rows += [(2000, None, None), (2001, "", ""), (2002, "bad\r\nWARC-Type: x <y>", "\r\n\r\nWARC/1.1\r\n"), (None, "http://a:99999/", "lone")]
    rows += [(None, "http://b:8080/x", "<p>1é</p>"), rows[5], rows[5], (2003, "http://b/", "x" * 300_000)]
    return rows


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, 0, "f", "p") for r in rows], PAGES)
    for min_bytes in (0, 100):
        index = warc.write_archives(df, min_bytes=min_bytes)
        got = warc.read_records(index, with_payload=True).collect()
        mine = [tuple(r)[:5] for r in got]
        assert sorted(mine, key=repr) == sorted(plain(rows, min_bytes), key=repr)
        texts = {(p, (h or "")) for p, _, h in rows}
        for r in got:
            if r["record_type"] == "response":
                assert (r["id"], bytes(r["payload"]).decode()) in texts
            else:
                assert not r["payload"]


def test_histories_in_global_order(spark, monkeypatch):
    monkeypatch.setattr(captureindex, "BATCH", 8)
    rows = pages()
    df = spark.createDataFrame([(*r, 0, "f", "p") for r in rows], PAGES).repartition(6)
    index = warc.write_archives(df, ts=F.timestamp_seconds(F.lit(10**9) + F.col("page_id") % 5))
    got = index.orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(rows)))
    keys = [captureindex.key_of((r["urlkey"], r["ts"], r["id"])) for r in got]
    assert keys == sorted(keys)
    want = sorted((warc.url_key(u), -(1 << 63) if p is None else p) for p, u, _ in rows)
    assert sorted((k, i) for k, _, i in keys) == want


def test_merge_in_rounds(spark, tmp_path, monkeypatch):
    """More runs than may be merged at once, runs of any length, one key with very many rows."""
    monkeypatch.setattr(captureindex, "BATCH", 4)
    rng = random.Random(3)
    found, everything = [], []
    for run in range(11):
        rows = [(rng.choice(["a", "b", "hot", "hot", "hot"]), str(rng.randint(0, 30)), rng.choice([None, run * 100 + i]), None, "d", "response", "f", i, 1) for i in range(rng.choice([1, 7, 40]))]
        everything += rows
        found += captureindex.write_run(f"{tmp_path}/run-{run}.arrow", sorted(rows, key=captureindex.key_of))
    batches = spark.createDataFrame(found, captureindex.BATCHES)
    merged = captureindex.merge_runs(batches, str(tmp_path), ranges=5, fan_in=3).orderBy("position")
    got = [tuple(r)[1:] for r in merged.collect()]
    assert [captureindex.key_of(r) for r in got] == sorted(map(captureindex.key_of, everything))
    assert sorted(got, key=repr) == sorted(everything, key=repr)


def test_loser_tree():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((str(rng.randint(0, 9)), "", rng.randint(0, 9)) for _ in range(rng.choice([0, 3, 20]))) for _ in range(n)]
        assert list(captureindex.LoserTree(map(iter, runs))) == sorted(r for run in runs for r in run)


def test_record_is_readable_by_others():
    raw = warc.record(5, "http://x/\n", "20200101000000", b"<p>", 9, warc.base32_sha1(b"<p>"))
    text = gzip.decompress(raw).decode()
    assert text.startswith("WARC/1.1\r\nWARC-Type: revisit\r\n") and text.endswith("\r\n\r\n")
    assert "WARC-Target-URI: http://x/%0A\r\n" in text and "WARC-Refers-To: <urn:page:9>" in text


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.COM:80/A?b#c") == "com,example)/a?b"
    assert warc.url_key("https://m.x.org:8080") == "org,x,m:8080)/"
    assert warc.url_key(None) == "" and warc.url_key("http://a:99999/") == "http://a:99999/"


def test_no_pages(spark):
    index = warc.write_archives(spark.createDataFrame([], PAGES))
    assert index.count() == 0 and warc.read_records(index).count() == 0


def test_longer_runs_are_files_of_key_ranges(spark, tmp_path, monkeypatch):
    """A group of runs is merged in several tasks, and no file holds the whole of it."""
    monkeypatch.setattr(captureindex, "BATCH", 4)
    found = []
    for run in range(7):
        rows = [(f"k{i:03d}", "", run, None, "d", "response", "f", i, 1) for i in range(100)]
        found += captureindex.write_run(f"{tmp_path}/run-{run}.arrow", rows)
    batches = spark.createDataFrame(found, captureindex.BATCHES)
    merged = captureindex.merge_runs(batches, str(tmp_path), ranges=8, fan_in=4).orderBy("position")
    got = [(r["urlkey"], r["id"]) for r in merged.collect()]
    assert got == [(f"k{i:03d}", run) for i in range(100) for run in range(7)]
    files = sorted((tmp_path / "merged-0").rglob("*.arrow"))
    assert len(files) > 2 * 2
    assert max(f.stat().st_size for f in files) < sum(f.stat().st_size for f in files) / 4


def test_run_is_written_batch_by_batch(tmp_path, monkeypatch):
    monkeypatch.setattr(captureindex, "BATCH", 64)
    sizes = []

    def rows():
        for i in range(6400):
            if i % 640 == 0:
                sizes.append(sum(f.stat().st_size for f in tmp_path.rglob("*.draft")))
            yield (f"k{i:05d}", "", i, "u" * 200, "d", "response", "f", i, 1)

    captureindex.write_run(f"{tmp_path}/run.arrow", rows())
    assert sizes[-1] > sizes[4] > 0


def test_any_page_id(spark):
    """Hashed ids are large; their made-up times stay within four-digit years."""
    from pyspark.sql import functions as F

    ids = [1 << 62, -1, 300_000_000_000, -(1 << 63), 5]
    df = spark.createDataFrame([(i, "http://a/", "x") for i in ids], "page_id long, url string, html string")
    index = warc.write_archives(df, min_bytes=0)
    assert sorted(r["id"] for r in warc.read_records(index).select(F.col("id")).collect()) == sorted(ids)
