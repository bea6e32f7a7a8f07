from __future__ import annotations

import io
import subprocess
import sys
import zipfile

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarterlode.functions import text as X
from quarterlode.operators import repairs as R
from quarterlode.plans import quarterly
from quarterlode.schemas import RESCUED, TABLES
from quarterlode.sources import archives as A
from quarterlode.sources import delimited as D
from quarterlode.sources.tables import load_periods, read_or_empty
from quarterlode.streaming.flows import tables_of

DEMO_HEADER = ("primaryid$caseid$caseversion$i_f_cod$event_dt$mfr_dt$init_fda_dt$fda_dt$rept_cod$auth_num$mfr_num"
               "$mfr_sndr$lit_ref$age$age_cod$age_grp$sex$e_sub$wt$wt_cod$rept_dt$to_mfr$occp_cod$reporter_country$occr_country")
DEMO_LINE = ("1001$500$1$I$20240101$20240102$20240103$20240104$EXP$AUTH1$MFR1$SNDR1$$65$YR$3$F$Y$70.5$KG$20240105"
             "$Y$MD$US$US")
DRUG_HEADER = ("primaryid$caseid$drug_seq$role_cod$drugname$prod_ai$val_vbm$route$dose_vbm$cum_dose_chr$cum_dose_unit"
               "$dechal$rechal$lot_num$exp_dt$nda_num$dose_amt$dose_unit$dose_form$dose_freq")
DRUG_LINE = "1001$500$1$PS$ASPIRIN$ASPIRIN$1$ORAL$100MG$$$N$N$LOT1$20250101$21505$100$MG$TABLET$DAILY"


def put(folder, name, *lines, raw: bytes = b""):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join(lines).encode() + b"\n" + raw)


def pack(path, **members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), data)


def parse(spark, folder, table):
    return D.parse_table(R.repair_files(A.read_lines(A.binary_files(spark, str(folder)))), table, 99)


def test_demo_file(spark, tmp_path):
    put(tmp_path, "demo24q1.txt", DEMO_HEADER, DEMO_LINE)
    row = parse(spark, tmp_path, "demo").first()
    assert (row.primaryid, row.caseid, row.event_dt, row.lit_ref, row.wt, row.occr_country) == (
        1001, 500, 20240101, None, 70.5, "US")
    assert (row.processing_time, row.period) == (99, "24q1")


def test_drug_file(spark, tmp_path):
    put(tmp_path, "DRUG24Q1.TXT", DRUG_HEADER, DRUG_LINE, "", "  \t")
    out = parse(spark, tmp_path, "drug")
    assert out.count() == 1
    row = out.first()
    assert (row.drugname, row.nda_num, row.exp_dt, row.dose_freq) == ("ASPIRIN", 21505.0, 20250101, "DAILY")


def test_older_sex_name(spark, tmp_path):
    put(tmp_path, "demo24q1.txt", DEMO_HEADER.replace("$sex$", "$gndr_cod$"), DEMO_LINE)
    assert parse(spark, tmp_path, "demo").first().sex == "F"


@pytest.mark.parametrize("name,header,line,column,want", [
    ("demo12q4.txt", DEMO_HEADER.replace("$rept_dt$", "$ rept_dt$"), DEMO_LINE, "rept_dt", 20240105),
    ("drug12q4.txt", DRUG_HEADER.replace("lot_num", "lot_nbr"), DRUG_LINE, "lot_num", "LOT1"),
    ("outc12q4.txt", "primaryid$caseid$outc_code", "1001$500$DE", "outc_cod", "DE"),
    ("demo18q1_new.txt", DEMO_HEADER, DEMO_LINE, "period", "18q1"),
])
def test_known_header_repairs(spark, tmp_path, name, header, line, column, want):
    put(tmp_path, name, header, line)
    assert parse(spark, tmp_path, name[:4]).first()[column] == want


def test_bad_bytes_are_left_out(spark, tmp_path):
    put(tmp_path, "drug19q3.txt", DRUG_HEADER, raw=b"\xff\xfe" + DRUG_LINE.encode() + b"\n")
    assert parse(spark, tmp_path, "drug").first().primaryid == 1001


@pytest.mark.parametrize("content,want", [
    (b"plain", "plain"), (b"\xffa\xe2\x82b\xc3\xa9\x80", "abé"), ("� x".encode() + b"\xff", "� x"),
    ("\U0001f600é".encode() + b"\xf0\x9f", "\U0001f600é"), (b"\xed\xa0\x80ok\xc0\xaf", "ok")])
def test_drop_bad_bytes(spark, content, want):
    assert content.decode("utf-8", "ignore") == want
    df = spark.createDataFrame([(bytearray(content),)], "c binary")
    assert df.select(X.drop_bad_bytes(F.col("c"))).first()[0] == want


def test_joined_records_are_split(spark, tmp_path):
    name, number, old, _ = R.LINE_REPAIRS[1]
    repairs = spark.createDataFrame([(name, 2, old, R.LINE_REPAIRS[1][3])], "file string, line_no long, old string, new string")
    put(tmp_path, name, "ISR$DRUG_SEQ$ROLE_COD$DRUGNAME$VAL_VBM$ROUTE$DOSE_VBM$DECHAL$RECHAL$LOT_NUM$EXP_DT$NDA_NUM",
        "1$2$PS$X$1$ORAL$1 MG$$$$$$", old, "3$4$PS$Y$1$ORAL$1 MG$$$$$$")
    lines = A.read_lines(A.binary_files(spark, str(tmp_path)))
    out = D.parse_table(R.repair_files(lines, repairs), "drug", 1)
    got = sorted((r.primaryid, r.drug_seq, r.val_vbm, r.caseid, r.period) for r in out.collect())
    assert got == [(1, 2, 1, None, "11q2"), (3, 4, 1, None, "11q2"),
                   (7475791, 1016572490, 2, None, "11q2"), (7475791, 1016572493, 1, None, "11q2")]
    assert number == 322966


def test_several_repairs_of_one_line(spark, rows):
    lines = spark.createDataFrame([("f", 3, "h", "a.b")], "file string, line_no long, header string, line string")
    repairs = spark.createDataFrame([("f", 3, "a", "x"), ("f", 3, ".", "\n")], "file string, line_no long, old string, new string")
    for small in (True, False):
        assert rows(R.repair_lines(lines, repairs, small), "part", "line") == [(0, "x"), (1, "b")]


def test_quotes_and_surplus_fields(spark):
    line = 'a$"b$c"$"d ""e"" f"$5" tube$"open$'
    df = spark.createDataFrame([(line,), ("a$$b",), ("",), ('"x"y$1',)], "l string")
    got = [r[0] for r in df.select(D.split_fields(F.col("l"))).collect()]
    assert got == [["a", "b$c", 'd "e" f', '5" tube', '"open', None], ["a", None, "b"], [None], ["xy", "1"]]


def test_unknown_columns_are_rescued(spark, tmp_path):
    put(tmp_path, "outc24q1.txt", "primaryid$caseid$outc_cod$novel$other$novel$", "1$2$DE$N$$Z$", "3$4$LT$$$$")
    lines = A.read_lines(A.binary_files(spark, str(tmp_path)))
    out = {r.primaryid: r[RESCUED] for r in D.parse_table(lines, "outc", 1, keep_rescued=True).collect()}
    assert out == {1: {"novel": "N"}, 3: None}


def test_unknown_tables_and_header_only(spark, tmp_path):
    put(tmp_path, "stat24q1.txt", "some content")
    put(tmp_path, "demo_readme.txt", DEMO_HEADER, DEMO_LINE)
    put(tmp_path, "demo24q1.txt", DEMO_HEADER)
    for table in TABLES:
        assert parse(spark, tmp_path, table).count() == 0


def test_archive_members(spark, tmp_path):
    demo = DEMO_HEADER + "\r\n" + DEMO_LINE + "\r\n"
    pack(tmp_path / "a.zip", **{"ASCII__DEMO24Q1_dot_TXT": demo, "ASCII__SIZE24Q1_dot_TXT": "x", "STAT24Q1_dot_TXT": "x",
                                "_dot_hidden_dot_txt": "x", "demo24q1_dot_csv": demo, "readme_dot_md": "x",
                                "ASCII__deep__Reac24Q1_dot_txt": "primaryid$caseid$pt\n1$2$PAIN\n"})
    files = A.binary_files(spark, str(tmp_path), "*.zip")
    lines = A.read_lines(files)
    got = sorted((r.member, r.file, r.line_no, r.line) for r in lines.collect())
    assert [g[:3] for g in got] == [("ASCII/deep/reac24q1.txt", "reac24q1.txt", 0), ("ASCII/deep/reac24q1.txt", "reac24q1.txt", 1),
                                    ("ASCII/demo24q1.txt", "demo24q1.txt", 0), ("ASCII/demo24q1.txt", "demo24q1.txt", 1)]
    assert got[3][3] == DEMO_LINE
    assert {r.file for r in A.read_lines(files, ("reac",)).collect()} == {"reac24q1.txt"}


def test_line_numbers_are_physical(spark, tmp_path):
    put(tmp_path, "reac24q1.txt", "primaryid$caseid$pt", "1$2$A\x0bB", "1$2$C D\x85")
    got = {r.line_no: r.line for r in A.read_lines(A.binary_files(spark, str(tmp_path))).collect()}
    assert got[1] == "1$2$A\x0bB" and got[2] == "1$2$C D\x85" and len(got) == 3


def test_large_member_comes_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "CHUNK_BYTES", 50_000)
    n = 30_005
    body = "primaryid$caseid$outc_cod\n" + "".join(f"{i}$1$DE\n" for i in range(n))
    pack(tmp_path / "a.zip", **{"outc24q1_dot_txt": body})
    lines = A.read_lines(A.binary_files(spark, str(tmp_path)))
    assert lines.count() == n + 1
    assert lines.agg(F.max("line_no"), F.count_distinct("line_no")).first() == (n, n + 1)


def test_listing(spark, tmp_path):
    for name in ("b.txt", "a.txt", "ignore.csv", "sub/c.md"):
        put(tmp_path, name, "x")
    assert [r.name for r in A.list_files(spark, str(tmp_path), "*.txt").collect()] == ["a.txt", "b.txt"]


def test_names(spark):
    names = ["size24q1.txt", "stat24q1.txt", ".hidden.txt", "demo24q1.csv", "readme.md", "demo24q1.txt", "DRUG24Q1.TXT"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.where(X.is_report_member(F.col("n"))).collect()] == names[5:]
    assert [n for n in names if A.is_member(n)] == names[5:]
    paths = spark.createDataFrame([("/x/file=demo24q1.txt/part-0.csv",), ("/x/Demo24Q1.txt",), ("/x/demo24q1.txt/part-0",), ("/x/a.zip",)], "p string")
    assert [r[0] for r in paths.select(X.logical_file(F.col("p"))).collect()] == ["demo24q1.txt"] * 3 + [None]


def test_headers_are_worked_out_once(spark, rows, tmp_path):
    """By the distinct headers or line by line, the rows are the same."""
    put(tmp_path, "demo24q1.txt", DEMO_HEADER, DEMO_LINE)
    put(tmp_path, "demo12q4.txt", "isr$case$gndr_cod$site$$ rept_dt$Case", "1$2$M$here$x$20120101$9$surplus", "3$$$$$$", "", "4")
    put(tmp_path, "demo10q1.txt", "sex$gndr_cod$isr$caseid", "$F$7$8", "M$F$9$")
    lines = A.read_lines(A.binary_files(spark, str(tmp_path)))
    headers = R.repaired_headers(lines.where("line_no = 0"))
    for keep in (False, True):
        plain = D.parse_table(R.repair_files(lines), "demo", 99, keep)
        once = D.parse_table(R.repair_files(lines), "demo", 99, keep, headers=headers)
        assert once.schema == plain.schema and rows(once) == rows(plain) and once.count() == 6
        assert "lower(header" in str(plain._jdf.queryExecution().optimizedPlan())
        assert "lower(header" not in str(once._jdf.queryExecution().optimizedPlan())


def test_correction_audit(spark, rows, tmp_path):
    put(tmp_path, "demo18q1_new.txt", DEMO_HEADER + "$confid$image", DEMO_LINE)
    (tmp_path / "drug19q3.txt").write_bytes(DRUG_HEADER.encode() + b"\n\xff" + DRUG_LINE.encode() + b"\xe2\x82")
    (tmp_path / "reac24q1.txt").write_bytes("primaryid$caseid$pt\n1$2$SJÖGREN\n3$4$é\n".encode("latin-1"))
    put(tmp_path, "drug12q4.txt", "isr$lot_nbr$drug_seq", "1$2$3")
    put(tmp_path, "size19q3.txt", "x")
    chunks = A.read_chunks(A.binary_files(spark, str(tmp_path)))
    lines = A.split_lines(chunks)
    assert {r.line for r in lines.where("file = 'reac24q1.txt'").collect()} == {"primaryid$caseid$pt", "1$2$SJÖGREN", "3$4$é"}
    assert rows(R.correction_audit(lines, R.known_repairs(spark), decoding=A.decoding_report(chunks))) == [
        ("demo18q1.txt", "column_drop", 2), ("demo18q1.txt", "column_rename", 1), ("demo18q1.txt", "file_rename", 1),
        ("drug12q4.txt", "column_add", 8), ("drug12q4.txt", "column_rename", 1), ("drug12q4.txt", "line_repair", 1),
        ("drug19q3.txt", "column_rename", 1), ("drug19q3.txt", "encoding", 3),
        ("reac24q1.txt", "column_add", 1), ("reac24q1.txt", "column_rename", 1), ("reac24q1.txt", "latin1", 2)]


def test_archives_to_tables(spark, tmp_path):
    """Two quarters of both eras through load, corrected text and ingest; a re-run changes nothing."""
    old = "ISR$DRUG_SEQ$INDI_PT\r\n5$1$PAIN$\r\n6$2$$\r\n"
    pack(tmp_path / "in/aers_ascii_2011q2.zip", **{"ascii__INDI11Q2_dot_TXT": old})
    pack(tmp_path / "in/faers_ascii_2024Q1.zip", **{"ASCII__INDI24Q1_dot_txt": "primaryid$caseid$indi_drug_seq$indi_pt\n7$70$1$FEVER\n",
                                                     "ASCII__DEMO24Q1_dot_txt": DEMO_HEADER + "\n" + DEMO_LINE + "\n"})
    want = [(5, None, 1, "PAIN", 7, "11q2"), (6, None, 2, None, 7, "11q2"), (7, 70, 1, "FEVER", 7, "24q1")]
    base = str(tmp_path / "out")
    for _ in range(2):
        quarterly.load_archives(spark, str(tmp_path / "in"), base, 7)
    schema = D.schema_of("indi")
    got = read_or_empty(spark, f"{base}/indi", schema)
    assert sorted((tuple(r) for r in got.collect())) == want
    assert read_or_empty(spark, f"{base}/demo", D.schema_of("demo")).count() == 1

    text, again = str(tmp_path / "text"), str(tmp_path / "again")
    quarterly.write_corrected_tables(spark, str(tmp_path / "in"), text, 7)
    assert quarterly.ingest_corrected(spark, f"{text}/indi", again, "indi", 1).first()[0] == "11q2,24q1"
    assert sorted(tuple(r) for r in read_or_empty(spark, f"{again}/indi", schema).collect()) == want


def test_zip_of_nothing(spark, tmp_path):
    empty = io.BytesIO()
    zipfile.ZipFile(empty, "w").close()
    (tmp_path / "x.zip").write_bytes(empty.getvalue())
    assert A.read_lines(A.binary_files(spark, str(tmp_path))).count() == 0


def test_reader_needs_no_package_on_executors(tmp_path):
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(A._chunk_batches))
    code = ("import pickle, pyarrow as pa\n"
            f"read = pickle.load(open({str(tmp_path / 'f.pkl')!r}, 'rb'))\n"
            "batch = pa.RecordBatch.from_pydict({'path': ['/x/a.txt'], 'content': [b'h\\nl\\n']})\n"
            "assert [b['chunk'].to_pylist() for b in read([batch], (), ())] == [['h\\nl']]\n")
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, env={"PATH": ""})
    assert done.returncode == 0, done.stderr


def test_withdrawn_cases_from_archives(spark, tmp_path):
    """Lists in any case, in name or folder, without a header; ids that are no numbers are counted."""
    pack(tmp_path / "in/a.zip", **{"DELETED__DELETE24Q1_dot_TXT": "12\r\n34\r\n", "deleted__cases_dot_txt": "56\nbad\n\n",
                                   "ASCII__DEMO24Q1_dot_TXT": DEMO_HEADER + "\n" + DEMO_LINE + "\n"})
    files = A.binary_files(spark, str(tmp_path / "in"))
    found = A.deleted_lines(A.read_lines(files, (A.DELETED,)))
    assert sorted((r.caseid, r.line) for r in found.where("caseid is not null").collect()) == [(12, "12"), (34, "34"), (56, "56")]
    assert [r.line for r in found.where("caseid is null").collect()] == ["bad"]
    quarterly.load_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), 3)
    assert {r.caseid for r in read_or_empty(spark, str(tmp_path / "out/deleted"), "caseid long").collect()} == {12, 34, 56}
    assert read_or_empty(spark, str(tmp_path / "out/demo"), D.schema_of("demo")).count() == 1


def test_a_broken_archive_is_left_out_and_named(spark, rows, tmp_path):
    """The others load; nothing of the broken one does, though its first member is sound."""
    pack(tmp_path / "in/good.zip", **{"ASCII__DEMO24Q1_dot_TXT": DEMO_HEADER + "\n" + DEMO_LINE + "\n",
                                      "DELETED__DELETE24Q1_dot_TXT": "12\nbad\n", "ASCII__drug19q3_dot_txt": DRUG_HEADER.encode() + b"\n\xff" + DRUG_LINE.encode(),
                                      "ASCII__outc24q1_dot_txt": "primaryid$caseid$outc_cod\n1$2$\u00e9\n".encode("latin-1")})
    pack(tmp_path / "in/late.zip", **{"ASCII__DEMO24Q2_dot_TXT": DEMO_HEADER + "\n" + DEMO_LINE + "\n", "ASCII__indi24q2_dot_txt": "primaryid$caseid\n1$2\n" * 50})
    late = (tmp_path / "in/late.zip").read_bytes()
    at = late.index(b"indi24q2.txt") + 40
    (tmp_path / "in/late.zip").write_bytes(late[:at] + bytes(x ^ 255 for x in late[at : at + 30]) + late[at + 30 :])
    (tmp_path / "in/cut.zip").write_bytes((tmp_path / "in/good.zip").read_bytes()[:200])
    audit = quarterly.load_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), 3)
    assert read_or_empty(spark, str(tmp_path / "out/demo"), D.schema_of("demo")).count() == 1
    assert read_or_empty(spark, str(tmp_path / "out/indi"), D.schema_of("indi")).count() == 0
    got = rows(audit, "file", "kind", "n")
    assert {("cut.zip", "unreadable", 1), ("late.zip", "unreadable", 1), ("delete24q1.txt", "no_number", 1), ("drug19q3.txt", "encoding", 1),
            ("outc24q1.txt", "latin1", 1), ("demo24q1.txt", "column_rename", 1)} <= set(got)
    assert not [g for g in got if g[0].startswith("demo24q2")] and len([g for g in got if g[1] == "unreadable"]) == 2
    assert audit.where("kind = 'unreadable' AND note RLIKE 'BadZipFile'").count() == 2
    quarterly.load_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), 3)
    assert rows(spark.read.schema(audit.schema).parquet(str(tmp_path / "out/audit/load=load-3")), "file", "kind", "n") == got
    with pytest.raises(Exception, match="BadZipFile"):
        A.read_lines(A.binary_files(spark, str(tmp_path / "in"))).count()


def test_archives_are_read_once_for_all_tables(spark, tmp_path):
    pack(tmp_path / "in/a.zip", **{"DEMO24Q1_dot_TXT": DEMO_HEADER + "\n" + DEMO_LINE + "\n"})
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    files = A.binary_files(spark, str(tmp_path / "in")).select("path", "content").mapInArrow(count, "path string, content binary")
    for rows in tables_of(files, 1).values():
        rows.count()
    assert seen.value == 1


def test_text_keeps_blanks_and_odd_characters(spark, tmp_path):
    odd = ["  both ends  ", "\ttab\t", 'say "hi"', "back\\slash", "dollar $ sign", " ", '"', "\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "primaryid long, outc_cod string")
    full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in D.schema_of("outc").fields])
    D.write_corrected(full, str(tmp_path / "t"))
    got = {r.primaryid: r.outc_cod for r in D.read_corrected(spark, str(tmp_path / "t"), "outc").collect()}
    assert got == {str(i): t for i, t in enumerate(odd)}


def test_two_loads_of_a_quarter_keep_both(spark, tmp_path):
    df = spark.createDataFrame([(1, "24q1"), (2, "24q1")], "x long, period string")
    for load, x in (("a", 1), ("b", 2), ("b", 2)):
        load_periods(df.where(F.col("x") == x), str(tmp_path / "t"), load)
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 2]
