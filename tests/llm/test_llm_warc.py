import gzip
import hashlib

from scorewright.llm import warc
from scorewright.llm.store import open_stored

BIG = "<p>" + "x" * 200 + "</p>"
ROWS = [(5, "http://a/5", BIG), (3, "http://a/3 é\n", BIG), (9, None, BIG), (9, None, BIG), (4, "u", "short"), (6, "u", "short"),
        (7, "u", None), (8, "u", ""), (None, "u", BIG), (None, None, None), (10, "u", "y" * 400_000), (3, "http://a/3 é\n", BIG),
        (None, "u", "w" * 150), (None, "v", "w" * 150), (None, "u", "short"), (13, "u", "v" * 100), (12, "u", "v" * 100), (12, "w", "v" * 100),
        (None, "u", "v" * 100), (11, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "z" * 100)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' as digest", "1 as shard", "2 as first", "3 as tie")


def expected(rows):
    first, out, told = {}, [], set()
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(page_id, first.get(data, page_id))
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = data in first and (page_id != first[data] or data in told)
        told.update([data] if page_id is not None and page_id == first.get(data) else [])
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response",
                    first[data] if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.round_trip(pages(spark), min_shards=3).drop("file").collect()
    assert sorted(map(tuple, got), key=str) == expected(ROWS)


def test_empty(spark):
    assert warc.round_trip(pages(spark).where("page_id = -1")).collect() == []


def test_files_are_rolled_and_reproducible(spark, scratch):
    rows = [(i, f"http://h/{i}", hashlib.sha256(str(i // 2).encode()).hexdigest() * 50) for i in range(400)]
    made = []
    for run in ("a", "b"):
        folder = f"{scratch}/{run}"
        manifest = warc.write(pages(spark, rows).repartition(3 if run == "a" else 5), folder, min_shards=2, roll_bytes=2_000)
        files = sorted(map(tuple, manifest.collect()))
        made.append(files)
        got = warc.read(manifest, folder).drop("file").collect()
        assert sorted(map(tuple, got), key=str) == expected(rows)
        for _, _, name, _, size, sha in files:
            data = open_stored(folder, name).read()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (size, sha)
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    assert made[0] == made[1]
    assert len(made[0]) > 4 and max(f[4] for f in made[0]) < 6_000


def test_damage_is_noticed(spark, scratch):
    folder = f"{scratch}/w"
    manifest = warc.write(pages(spark), folder, min_shards=1)
    name = manifest.first()["file"]
    path = f"{folder}/{name}"
    data = gzip.decompress(open(path, "rb").read()).replace(b"x" * 200, b"y" + b"x" * 199, 1)
    open(path, "wb").write(gzip.compress(data))
    try:
        warc.read(manifest, folder).collect()
    except Exception as error:
        assert "does not match its digest" in str(error)
    else:
        raise AssertionError("a damaged record was accepted")


def test_rows_without_an_id_do_not_depend_on_the_layout(spark, scratch):
    rows = ROWS * 3 + [(None, f"http://h/{i}", "q" * 120 + str(i // 3)) for i in range(60)]
    made = []
    for parts in (1, 6):
        folder = f"{scratch}/{parts}"
        manifest = warc.write(pages(spark, rows).repartition(parts), folder, min_shards=3, roll_bytes=3_000)
        made.append(sorted(map(tuple, manifest.collect())))
        assert sorted(map(tuple, warc.read(manifest, folder).drop("file").collect()), key=str) == expected(rows)
    assert made[0] == made[1]


def test_cut_points_are_even_shares(spark):
    """Against a plain running sum over the sorted keys; an id may be cut
    inside of its rows, a heavy key skips shards."""
    rows = [(i // 100, f"{i * 37 % 101:03d}{i}", 300 if i == 50 else i % 13) for i in range(300)]
    got = [warc.cut_points(spark.createDataFrame(rows, "id long, tie string, size long").repartition(n), 20) for n in (1, 4)]
    total, seen, want = sum(r[2] + 1 for r in rows), 0, {}
    for key_id, tie, size in sorted(rows):
        want.setdefault(seen * 20 // total, (key_id, tie))
        seen += size + 1
    assert got[0] == got[1] == [(s, *k) for s, k in sorted(want.items()) if s]
    assert len({k for _, k, _ in got[0]}) < len(got[0]) < 19


def test_shards_follow_the_keys(spark, scratch):
    """Ids in many rows with payloads of their own are cut between them."""
    rows = [(i % 3, f"http://h/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 4) for i in range(600)]
    manifest = warc.write(pages(spark, rows), scratch, min_shards=12)
    assert sorted(map(tuple, warc.read(manifest, scratch).drop("file").collect()), key=str) == expected(rows)
    sizes = [r["records"] for r in manifest.collect()]
    assert len(sizes) == 12 and sum(sizes) == 600 and max(sizes) <= 60
