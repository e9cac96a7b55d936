import random

import pytest

from retailspark.schemas import NA_TOKENS
from retailspark.session import scratch_folder
from retailspark.sources import files
from tests.conftest import values


def test_latin1_is_found_and_read(spark, tmp_path):
    path = tmp_path / "latin1.csv"
    path.write_bytes("id,name\n1,café\n2,x\n3,y\n".encode("latin-1"))
    assert files.pick_encoding(spark, str(path)) == "ISO-8859-1"
    assert values(files.read_csv(spark, str(path))) == [("1", "café"), ("2", "x"), ("3", "y")]


def test_utf8_is_kept(spark, tmp_path):
    path = tmp_path / "utf8.csv"
    path.write_text("id,name\n1,café\n", encoding="utf-8")
    assert files.pick_encoding(spark, str(path)) == "UTF-8"
    assert values(files.read_csv(spark, str(path))) == [("1", "café")]


def test_na_tokens_become_null(spark, tmp_path):
    path = tmp_path / "na.csv"
    path.write_text("id,v\n" + "".join(f"{i},{t}\n" for i, t in enumerate(NA_TOKENS)) + "z,na\n")
    got = values(files.read_csv(spark, str(path)))
    assert [v for _, v in got if v is not None] == ["na"]
    assert len(got) == len(NA_TOKENS) + 1


def test_quotes_and_column_order_follow_the_header(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('Name,ID\n"a, ""b""",1\n')
    df = files.read_csv(spark, str(path))
    assert df.columns == ["Name", "ID"] and values(df) == [('a, "b"', "1")]


def test_quoted_line_breaks_on_request(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('id,v\n1,"a\nb"\n')
    assert values(files.read_csv(spark, str(path), multiline=True)) == [("1", "a\nb")]


def test_each_file_of_a_folder_has_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,n\u00e4me\n1,Zo\u00eb\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("id,n\u00e4me\n2,Zo\u00eb\n".encode("latin-1"))
    assert files.pick_encoding(spark, str(tmp_path)) == files.MIXED
    for multiline in (False, True):
        df = files.read_csv(spark, str(tmp_path), multiline=multiline)
        assert df.columns == ["id", "n\u00e4me"] and values(df) == [("1", "Zo\u00eb"), ("2", "Zo\u00eb")]
    with (tmp_path / "a.csv").open("ab") as file:
        file.write(b"3\n")
    (bad,) = files.malformed_records(spark, str(tmp_path)).collect()
    assert bad.record == "3"


def test_a_record_with_too_few_fields_is_found_whatever_is_selected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,A\n3\n")
    assert [r.record for r in files.malformed_records(spark, str(tmp_path)).collect()] == ["3"]
    kept = files.read_csv(spark, str(tmp_path), on_malformed="quarantine")
    assert values(kept.select("id")) == [("1",)]
    with pytest.raises(Exception, match="malformed record"):
        files.read_csv(spark, str(tmp_path)).select("id").collect()


def _field(rnd):
    kind = rnd.random()
    if kind < 0.25:
        return rnd.choice(["", "x", "\u00e9", '12" pipe', "a b", " lead", "NA"])
    if kind < 0.5:
        return rnd.choice(['"q"', '"a,b"', '"say ""hi"""', '""""', '"\u00e9,\u00fc"'])
    if kind < 0.8:
        parts = ["l1", "two, words", '""quoted""', "x", "", 'end,"",']
        return '"' + "\n".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) + '"'
    if kind < 0.81:  # longer than a byte range
        return '"' + "\n".join(f"long line {i}, with commas" for i in range(400)) + '"'
    return str(rnd.random())


@pytest.mark.parametrize("encoding, newline", [("utf-8", "\n"), ("latin-1", "\r\n")])
def test_many_tasks_read_one_file_with_quoted_breaks(spark, tmp_path, encoding, newline):
    rnd = random.Random(4)
    text = "id,a,b,c\n" + "".join(",".join([str(i), _field(rnd), _field(rnd), _field(rnd)]) + "\n" for i in range(1500))
    path = tmp_path / "t.csv"
    path.write_bytes(text.replace("\n", newline).encode(encoding))
    reader = spark.read.options(header=True, escape='"', multiLine=True, encoding="ISO-8859-1" if encoding == "latin-1" else "UTF-8")
    want = values(files.normalise_na(reader.csv(str(path))))
    settings = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df = files.read_csv(spark, str(path), multiline=True)
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 20
        assert values(df) == want
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_missing_raw_files_are_listed(spark, tmp_path):
    (tmp_path / "brands.csv").write_text("brand_id,brand_name\n1,A\n")
    found, missing = files.load_raw(spark, str(tmp_path), ["brands", "stores"])
    assert list(found) == ["brands"] and missing == ["stores"]


def test_scratch_folder_is_fresh_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one != two and one.startswith(shared)


def test_scratch_folder_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return "yarn" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session(), "x")
