"""Archives that queries write: compressed, in files of bounded size, whatever the number of records."""

import gzip
from pathlib import Path

import pytest

from benchledger import fixtures as fx
from benchledger import queries
from benchledger.functions import variant

SF = "/root/testdata/sf0.001"


def _archive(spark, monkeypatch, tmp_path, query):
    monkeypatch.setattr(fx, "ARCHIVE_RECORDS", 500)
    monkeypatch.setattr(queries, "new_path", lambda _, name: str(tmp_path / name))
    rows = query(spark, SF).count()
    files = [f for name in ("records", "damaged", "arrivals") for f in Path(tmp_path, name).rglob("part-*")]
    return rows, files


@pytest.mark.parametrize("name", ["ingest_records", "stream_ingest", "compacted_records", "ingest_quarantine", "stream_latest_results"])
def test_archives_are_small(spark, monkeypatch, tmp_path, name):
    rows, files = _archive(spark, monkeypatch, tmp_path, queries.QUERIES[name])
    assert rows and len(files) > 10
    texts = [gzip.decompress(f.read_bytes()) for f in files]
    assert max(t.count(b"\n") for t in texts) <= 600
    assert sum(f.stat().st_size for f in files) * 5 < sum(map(len, texts))


def test_fields_of_all_levels_from_one_scan(spark, capsys):
    texts = ['JSON: {"a":{"b":{"c":1,"d":[{"e":2}]}},"f":{},"a.b":null}', 'JSON: {"a":{"b":"x"}}', 'JSON: [1]', "none", None]
    rows = spark.createDataFrame([(t,) for t in texts], "stdout string")
    fields = variant.output_fields(variant.with_variant(rows))
    assert sorted(map(tuple, fields.collect())) == [
        ("$.a", "object", 2), ("$.a.b", "null", 1), ("$.a.b", "object", 1), ("$.a.b", "string", 1),
        ("$.a.b.c", "number", 1), ("$.a.b.d", "array", 1), ("$.f", "object", 1),
    ]
    fields.explain("simple")
    assert capsys.readouterr().out.split("Initial Plan")[-1].count("Scan ExistingRDD") == 1
