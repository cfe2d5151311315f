"""WARC round trips and URL rules."""

import hashlib
import io

import pytest
import zstandard
from check import compare
from pyspark.sql import functions as F

from eventloom.llm import queries, url_cascade, warc_zstd
from eventloom.session import work_dir

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_equals_its_check_text(spark, name):
    assert compare(spark, SF, queries.QUERIES[name], queries.CHECKS[name]) is None


def awkward_pages(spark):
    big = "<p>" + "é" * 1200
    rows = [(1, "http://A.Example.com/x y\n?q#f", big), (2, None, big), (3, "no scheme", None), (4, "", ""), (5, "https://h", "short"), (6, "https://h", "short"), (7, "x://h/" + "p" * 5000, big), (7, "x://h/", big), (None, "http://n/", "null id"), (8, "http://z/", "x" * 300_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("digest", "size", "kept", "revisit", "path", "rule")})


def test_archives_round_trip(spark):
    pages = awkward_pages(spark)
    manifest = warc_zstd.archive_pages(pages, work_dir(spark, "warc-test"))
    assert manifest.agg(F.sum("records")).first()[0] == pages.count()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc_zstd.read_archives(manifest).collect()), key=str)
    want = []
    for r in pages.collect():
        data = (r.html or "").encode()
        revisit = r.page_id in (1, 2)
        want.append((r.page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None))
    assert got == sorted(want, key=str)
    full = {r.page_id: r.payload for r in warc_zstd.read_archives(manifest, payloads=True).collect()}
    assert full[8] == b"x" * 300_000 and full[5] == b"short" and full[2] is None


def test_small_archives_and_no_pages(spark):
    pages = awkward_pages(spark)
    marked = warc_zstd.with_revisits(pages)
    manifest = warc_zstd.write_archives(marked.coalesce(1), work_dir(spark, "warc-test"), archive_bytes=1)
    assert manifest.count() == pages.count() and warc_zstd.read_archives(manifest).count() == pages.count()
    none = warc_zstd.archive_pages(pages.filter("false"), work_dir(spark, "warc-test"))
    assert none.count() == 0 and warc_zstd.read_archives(none).count() == 0


def test_reader_needs_each_rule():
    good = warc_zstd.record(1, "http://x/", b"payload", None, False)
    assert warc_zstd.parse(good, "here")["payload"] == b"payload"
    for bad in (good[:-1], good.replace(b"payload\r\n", b"paxload\r\n"), good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"WARC-Date", b"X-Date"), good + b"x"):
        with pytest.raises(ValueError):
            warc_zstd.parse(bad, "here")
    frame = zstandard.ZstdCompressor(write_content_size=True).compress(good)
    with pytest.raises(ValueError):
        list(warc_zstd._frames(io.BytesIO(frame[:-4]), "here"))
    with pytest.raises(ValueError):
        list(warc_zstd._frames(io.BytesIO(b"junk" + frame), "here"))
    assert [c for _, c in warc_zstd._frames(io.BytesIO(frame * 3), "here")] == [good] * 3


def test_first_frame_holds_the_dictionary(spark):
    manifest = warc_zstd.archive_pages(spark.read.parquet(f"{SF}/pages.parquet"), work_dir(spark, "warc-test"))
    data = open(manifest.first().path.removeprefix("file:"), "rb").read()
    assert int.from_bytes(data[:4], "little") == warc_zstd.DICTIONARY_FRAME
    size = int.from_bytes(data[4:8], "little")
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    first = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(plain)).decompressobj().decompress(data[8 + size :])
    assert first.startswith(b"WARC/1.1")


def brute_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for c in "?#":
            rest = rest.split(c, 1)[0]
        host, slash, tail = rest.partition("/")
        path = slash + tail
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")


RULES = [*url_cascade.RULES, ("a.b.c", "/x", "block"), ("b.c", "/xy/z", "allow"), ("plain", "", "block")]


def test_cascade_is_exact(spark):
    urls = ["http://sub.EXAMPLE.net/en/1", "http://example.net", "http://example.net/en", "http://xexample.net/en/", "https://a.b.c/xy/z?x", "https://b.c/xy/zz", "https://q.a.b.c/x", "s://plain", "s://not.plain/", "http://org/fr/é", None, "", "nothing", "a://b://c.net/", "http:///fr/", "http://.net/", "http://x.net?/en/", "x://h.org/fr/" + "p" * 3000]
    urls += [f"http://{'abcdef'[i % 6]}{i}.{d}/{p}/{i}" for i in range(3000) for d, p in ((("net", "org", "com")[i % 3], ("en", "fr", "de")[i % 7 % 3]),)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, urls[0]])], "page_id long, url string").withColumns({c: F.lit("clash") for c in ("host", "path", "rule", "verdict", "key")})
    got = {r.page_id: tuple(r)[1:] for r in url_cascade.judge_urls(pages, url_cascade.rule_table(spark, RULES)).collect()}
    assert got == {i: brute_verdict(u, RULES) for i, u in enumerate([*urls, urls[0]])}
    assert url_cascade.judge_urls(pages.filter("false"), url_cascade.rule_table(spark)).count() == 0


def test_cascade_membership_over_its_universe(spark):
    """Many keys and a tight first level, so that later levels are needed."""
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 11 == 0).alias("in"))
    levels = url_cascade.build_cascade(universe, F.col("in"))
    assert len(levels) > 2
    assert universe.filter(url_cascade.is_listed(F.col("key"), levels) != F.col("in")).count() == 0
    with pytest.raises(ValueError):
        url_cascade.build_cascade(universe, F.col("in"), most_bits=64)


def test_hosts_of_many_labels(spark):
    """Keys follow the rules' forms, so a host's labels cost no more than reading them."""
    hosts = ["a." * 50_000 + "net", "b." * 9_000 + "a.b.c", "." * 20_000 + "org", "x" * 40_000 + ".example.com"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("/de/1", "/fr/", "/x", "")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: tuple(r)[1:] for r in url_cascade.judge_urls(pages, url_cascade.rule_table(spark, RULES)).collect()}
    assert got == {i: brute_verdict(u, RULES) for i, u in enumerate(urls)}
