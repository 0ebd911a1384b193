"""The MER data source against the tables made of whole files."""

import pytest
from pyspark.sql import functions as F

from pelagia.operators import mer
from pelagia.plans.normalize import mer_tables, read_mer
from pelagia.sources import mer_format
from pelagia.sources.files import discover
from test_mer_and_state import EVENT, HEAD

GOOD = EVENT % b"0123456789ab"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("mer")
    (root / "deep").mkdir()
    files = {
        "06_1.MER": HEAD + GOOD + EVENT % b"</DATA><EVEN", "06_2.MER": HEAD.replace(b"<NEWTAG A=1 />", b"no tag \xe9\xff") + b"<EVENT>half", "deep/06_3.mer": HEAD + HEAD + GOOD.replace(b"LENGTH=3", b"LENGTH=x") + GOOD,
        "06_4.MER": b"nothing here", "06_5.MER": b"", "06_6.MER": GOOD.replace(b"INFO", b"NOINFO"), "06_7.LOG": HEAD, "06_8.MER": HEAD + b"".join(EVENT % (b"%012d" % i) for i in range(50)),
    }
    for name, data in files.items():
        (root / name).write_bytes(data)
    return str(root)


def _rows(df):
    plain = df.select(*(F.to_json(F.struct(c)).alias(c) for c in sorted(df.columns)))
    return sorted(map(tuple, plain.collect()))


def test_tables_are_those_of_whole_files(spark, folder):
    whole, read = mer_tables(discover(spark, folder, ("mer",))), read_mer(spark, folder)
    for name, table in whole.families.items():
        assert _rows(read.families[name]) == _rows(table) != []
    assert _rows(read.quarantine) == _rows(whole.quarantine) != []
    assert _rows(read.skipped) == _rows(whole.skipped) and [r.source_path[-8:] for r in read.skipped.collect()] == ["06_4.MER"]


def test_partitions_follow_the_sizes_of_files(spark, folder, monkeypatch):
    mer_format.register(spark)
    reader = lambda n: mer_format.MerReader({"path": folder, "partitionbytes": str(n)})
    assert len(reader(1 << 20).partitions()) == 1 and len(reader(1).partitions()) == 6
    one, many = (_rows(spark.read.format("mer").option("partitionBytes", n).load(folder)) for n in (1 << 20, 1))
    assert one == many
    monkeypatch.setattr(mer_format, "BATCH_BYTES", 100)
    batches = list(reader(1 << 20).read(reader(1 << 20).partitions()[0]))
    assert len(batches) > 3 and sum(b.num_rows for b in batches) == len(one)


def test_modes_blocks_and_single_files(spark, folder, tmp_path):
    mer_format.register(spark)
    read = spark.read.format("mer")
    with pytest.raises(Exception, match="malformed MER block in .*06_2.MER: event without data"):
        read.option("mode", "strict").load(f"{folder}/06_2.MER").collect()
    assert spark.read.format("mer").option("mode", "strict").load(f"{folder}/06_8.MER").count() == 52
    only = spark.read.format("mer").option("blocks", "event").load(folder)
    assert {r.block for r in only.select("block").collect()} == {"event"} and only.where("error is null").count() == 2 + 2 + 1 + 50
    for options, said in (({"mode": "lax"}, "mode is"), ({"blocks": "x"}, "blocks are"), ({"path": f"{folder}/none"}, "no such path")):
        with pytest.raises(ValueError, match=said):
            mer_format.MerReader({"path": folder, **options}).partitions()
    assert spark.read.format("mer").load(str(tmp_path)).count() == 0


def test_a_file_that_changes_after_planning_ends_the_job(tmp_path):
    (tmp_path / "a.MER").write_bytes(GOOD)
    reader = mer_format.MerReader({"path": str(tmp_path)})
    parts = reader.partitions()
    (tmp_path / "a.MER").write_bytes(GOOD + GOOD)
    with pytest.raises(RuntimeError, match="has changed"):
        list(reader.read(parts[0]))


def test_blocks_of_odd_bytes():
    assert list(mer_format.blocks(b"")) == [("none", 0, None, None, None, None, mer.NOTHING)]
    assert [b[:3] for b in mer_format.blocks(b"<PARAMETERS>\xe9</PARAMETERS>")] == [("parameter", 0, "\xe9")]
