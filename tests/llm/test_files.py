import hashlib
import io
import math
import struct
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from sunsieve.llm import archives, hypergeometric, queries
from sunsieve.llm.common import open_store
from sunsieve.llm.hypergeometric import communication_matrix, shard_sizes, shuffle_into_shards
from sunsieve.sources.shared import landed, shared_folder

SAME = "<p>the same page</p>" * 6


def pages(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def roundtrip(spark, rows, **options):
    folder = shared_folder(spark, "archives")
    written = archives.write_packages(archives.planned(pages(spark, rows)), folder, **options)
    return archives.read_packages(written.union(written), folder).collect()


def test_pages_come_back_from_their_archives(spark):
    rows = [(5, "http://a/\r\nb", SAME), (3, None, SAME), (9, "http://c", SAME), (3, "again", SAME), (4, "u", "short"), (6, "u", "short")]
    rows += [(7, "x", None), (None, "n", SAME), (8, "é", "é🙂\r\n\r\n" * 50), (10, "big", "y" * 3_000_000)]
    found = roundtrip(spark, rows, package_bytes=1)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in found) == Counter(
        [(5, "revisit", 3), (3, "response", None), (3, "response", None), (9, "revisit", 3), (None, "revisit", 3)]
        + [(k, "response", None) for k in (4, 6, 7, 8, 10)]
    )
    html = {r[0]: (r[2] or "").encode() for r in rows}
    for r in found:
        assert r.payload_bytes == len(html[r.page_id]) and r.digest == hashlib.sha256(html[r.page_id]).hexdigest()
        assert (None if r.payload is None else bytes(r.payload)) == (html[r.page_id] if r.record_type == "response" else None)
    assert {r.uri for r in found if r.page_id == 5} == {"http://a/%0D%0Ab"}


def test_no_pages_and_pages_without_ids(spark):
    assert roundtrip(spark, []) == []
    found = roundtrip(spark, [(None, "a", SAME), (None, "b", SAME)])
    assert [(r.page_id, r.record_type) for r in found] == [(None, "response")] * 2


def test_a_package_is_a_zip_that_others_read(spark):
    folder = shared_folder(spark, "archives")
    names = archives.write_packages(archives.planned(pages(spark, [(k, "u", f"page {k}") for k in range(9)])), folder)
    store, at = open_store(folder)
    for row in names.collect():
        with store.open_input_file(f"{at}/{row.file}") as file:
            raw = file.read()
        with zipfile.ZipFile(io.BytesIO(raw)) as package:
            own = list(archives.members(io.BytesIO(raw), len(raw)))
            assert [m.filename for m in package.infolist()] == [m[0] for m in own] == [archives.DATA, archives.INDEX]
            for name, method, place, size in own:
                assert method == 0 and raw[place : place + size] == package.read(name)


def test_zip64_directories_are_parsed():
    name, data = b"archive/x", b"stored bytes"
    local = archives.LOCAL + struct.pack("<5H3I2H", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(data), len(data))
    extra = struct.pack("<HHB", 9, 1, 7) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), 3)
    central = archives.CENTRAL + struct.pack("<6H3I5H2I", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 4, 0, 0, 0, 0xFFFFFFFF)
    central += name + extra + b"note"
    body = b"pad" + local + data
    end64 = archives.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), len(body))
    locator = archives.LOCATOR64 + struct.pack("<IQI", 0, len(body) + len(central), 1)
    end = archives.END + struct.pack("<4H2IH", 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 2) + b"hi"
    raw = body + central + end64 + locator + end
    [(found, method, place, size)] = archives.members(io.BytesIO(raw), len(raw))
    assert (found, method, raw[place : place + size]) == ("archive/x", 0, data)
    with pytest.raises(ValueError, match="no end record"):
        list(archives.members(io.BytesIO(b"x" * 40), 40))


def test_the_matrix_has_exact_margins_and_the_right_mean():
    counts, sizes = [7, 0, 120, 33], list(shard_sizes(160, 6))
    total = np.zeros((4, 6))
    for seed in range(400):
        matrix = communication_matrix(counts, sizes, seed)
        assert list(matrix.sum(axis=1)) == counts and list(matrix.sum(axis=0)) == sizes and matrix.min() >= 0
        total += matrix
    want = np.outer(counts, sizes) / 160
    assert np.abs(total / 400 - want).max() < 0.5
    assert communication_matrix([], [0, 0], 0).shape == (0, 2)
    large = communication_matrix([3 * 10**9, 10**9], shard_sizes(4 * 10**9, 3), 1)
    assert list(large.sum(axis=1)) == [3 * 10**9, 10**9] and list(large.sum(axis=0)) == list(shard_sizes(4 * 10**9, 3))


def test_shards_hold_every_row_once_in_gapless_slots(spark):
    rows = odd.documents(spark, odd.ROWS * 30)
    found = shuffle_into_shards(rows, 7, seed=3, slice_rows=10).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((d, t) for d, t, _ in odd.ROWS * 30)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert {k: sorted(v) for k, v in slots.items()} == {k: list(range(n)) for k, n in enumerate(shard_sizes(len(odd.ROWS) * 30, 7))}
    assert shuffle_into_shards(rows.limit(0), 4).isEmpty()


def test_every_shard_and_slot_is_equally_likely(spark):
    ids = spark.range(40).repartition(4)
    hits = np.zeros((40, 4))
    for seed in range(25):
        for r in shuffle_into_shards(ids, 4, seed).where(F.col("id") < 40).collect():
            hits[r.id, r.shard] += 1
    # 25 draws of one in four for each id: six deviations are 13.
    assert np.abs(hits - 25 / 4).max() < 13 and hits.sum() == 1000


@pytest.mark.parametrize("good, bad, n", [(60, 90, 50), (5, 400, 37), (1, 3, 2), (300, 2, 299), (10**7, 3 * 10**7, 40)])
def test_tabulated_draws_follow_the_law(good, bad, n):
    rng, trials = np.random.default_rng(8), 4000
    found = Counter(hypergeometric.draw(rng, good, bad, n, numpy_rows=0) for _ in range(trials))
    total = math.comb(good + bad, n)
    law = {k: math.comb(good, k) * math.comb(bad, n - k) / total for k in range(max(0, n - bad), min(n, good) + 1)}
    assert set(found) <= set(law)
    for k, share in law.items():
        assert abs(found[k] - trials * share) <= 6 * (trials * share) ** 0.5 + 1


def test_draws_from_many_rows_keep_the_shape_of_few():
    # A few rows of ten billion, one in a thousand good: nearly all draws have none or one.
    rng = np.random.default_rng(4)
    found = Counter(hypergeometric.draw(rng, 10**7, 10**10 - 10**7, 100) for _ in range(20_000))
    for k, share in enumerate((0.904792, 0.090570, 0.004487)):
        assert abs(found[k] - 20_000 * share) <= 6 * (20_000 * share) ** 0.5
    many = [hypergeometric.draw(rng, 4 * 10**9, 6 * 10**9, 10**6) for _ in range(2_000)]
    assert abs(np.mean(many) - 400_000) < 6 * 490 / 2_000**0.5 and abs(np.std(many) / 489.9 - 1) < 0.1


def test_rows_keep_their_partition_however_files_are_cut(spark, monkeypatch):
    seen = []

    def cut_otherwise(df, name, keep=False):
        found = landed(df, name, keep)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", [1, 7, 2, 5][len(seen) % 4])
        seen.append(name)
        return found

    monkeypatch.setattr(hypergeometric, "landed", cut_otherwise)
    rows = spark.range(500).repartition(6)
    try:
        found = shuffle_into_shards(rows, 3, seed=5).collect()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert sorted(r.id for r in found) == list(range(500)) and len(seen) == 2
    assert Counter(r.shard for r in found) == {0: 167, 1: 167, 2: 166}


def test_query_gives_every_document_its_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = queries.op6_hypergeometric_shards(spark, sf).collect()
    want = Counter((d, len(t.encode()) + 1, zlib.crc32(t.encode()), "rows", None) for d, t in docs)
    # A null text has no bytes, an empty one none either.
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in found) == want
    slots = sorted((r.shard, r.slot) for r in found)
    assert slots == [(k, i) for k, n in enumerate(shard_sizes(len(docs), 8)) for i in range(n)]
