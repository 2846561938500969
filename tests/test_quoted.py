import random

import pytest

from slotstream.sources import files, quoted

NAMES = ["slotID", "patientID", "version", "diagnosis", "treatment", "updated_at"]
PIECES = ["a", '"', ",", "\n", "\n\n", "é", " ", '""', '",\n"', "x" * 40, '"\n', "\r\n"]


@pytest.fixture
def small_blocks(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], 300)
    spark.conf.set(names[1], 0)
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def field(rng, text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') or rng.random() < 0.2 else text


def made(seed, end="\n", n=120):
    rng = random.Random(seed)
    out, wanted = [",".join(NAMES)], []
    for i in range(n):
        notes = ["n" + "".join(rng.choices(PIECES, k=rng.randrange(0, 9))) + "z" for _ in range(2)]
        wanted.append((f"S{i}", *notes))
        out.append(",".join([f"S{i}", str(i), "1", *[field(rng, x) for x in notes], "2026-01-01 08:00:00"]))
    return end.join(out) + end, wanted


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n"), (3, "\r\n")])
def test_breaks_across_blocks(spark, tmp_path, rows, small_blocks, seed, end):
    text, wanted = made(seed, end)
    path = tmp_path / "records.csv"
    path.write_bytes(text.encode())
    found = files.record_csv(spark, str(path), splits=True, lines=True)
    assert rows(found, "slot_id", "diagnosis_note", "prescription_note") == sorted(wanted)
    assert found.select("_block").distinct().count() > 10
    in_order = [r.slot_id for r in found.orderBy(*files.LINE).collect()]
    assert in_order == [x[0] for x in wanted]


def test_one_record_over_many_blocks(spark, tmp_path, rows, small_blocks):
    long = "line of a long note\n" * 200 + "end"
    lines = [",".join(NAMES), f'S1,1,1,"{long}",t,2026-01-01', "", 'S2,2,1,5" pipe,"he said ""no"", then\nleft",x']
    (tmp_path / "a.csv").write_text("\n".join(lines))
    found = files.record_csv(spark, str(tmp_path), splits=True)
    assert rows(found, "slot_id", "diagnosis_note", "prescription_note") == [
        ("S1", long, "t"), ("S2", '5" pipe', 'he said "no", then\nleft'),
    ]


def test_same_as_the_reader(spark, tmp_path, rows):
    lines = [
        "\ufeff" + ",".join(NAMES), 'S1,1,1,"",,', "S2,2,1", 'S3,3,1,a"b,"c""","""d"', "S4,x,1,  , e ,2026-01-01",
        "", 'S5,5,1,"a\n\nb",c,2026-01-01',
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("\n".join(lines[:1] + ['S6,1,2,"open\nnote",x,2026-01-01']) + "\n")
    plain = files.record_csv(spark, str(tmp_path))
    assert rows(files.record_csv(spark, str(tmp_path), splits=True)) == rows(plain)


def test_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(NAMES) + "\nS1,1,1,a,b,\n")
    (tmp_path / "b.csv").write_text(",".join(reversed(NAMES)) + "\nS1,1,1,a,b,\n")
    with pytest.raises(Exception, match="other header"):
        files.record_csv(spark, str(tmp_path), splits=True).collect()


def test_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(NAMES) + "\n")
    assert files.record_csv(spark, str(tmp_path), splits=True).count() == 0
    assert quoted.records(spark, str(tmp_path)).count() == 1
