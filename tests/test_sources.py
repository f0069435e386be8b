import bz2
import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from linkloom.sources import records
from linkloom.sources.delimited import ORDINAL, read_delimited, read_raw

HEADER = "patent_id\ttype\tdate\ttitle\tabstract\n"


def put(folder, name, text, pack=None):
    data = text.encode()
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(pack(data) if pack else data)


def rows(frame, *columns):
    return [tuple(r) for r in frame.orderBy(ORDINAL).select(*columns).collect()]


def test_only_wanted_columns_as_text_in_file_order(spark, tmp_path):
    put(tmp_path, "g_patent.tsv", HEADER + "2\tu\t2020-01-01\tB\tb\n1\tu\t2020-01-02\tA\tNA\n")
    frame = read_raw(spark, str(tmp_path), "g_patent")
    assert set(frame.columns) == {"patent_id", "title", "abstract", "date", ORDINAL}
    assert {kind for name, kind in frame.dtypes if name != ORDINAL} == {"string"}
    assert rows(frame, "patent_id", "abstract") == [("2", "b"), ("1", None)]


def test_missing_columns_are_skipped(spark, tmp_path):
    put(tmp_path, "g_assignee_disambiguated.tsv", "assignee_id\tcountry\na\tNA\n")
    frame = read_raw(spark, str(tmp_path), "g_assignee_disambiguated")
    assert set(frame.columns) == {"assignee_id", "country", ORDINAL}
    assert rows(frame, "assignee_id", "country") == [("a", "NA")]


def test_quoted_field_with_quotes_tab_and_line_break(spark, tmp_path):
    put(tmp_path, "g_patent.tsv", HEADER + '1\tu\t2020-01-01\t"a ""b""\tc\nd"\t""\n2\tu\t\tz\t\n')
    frame = read_raw(spark, str(tmp_path), "g_patent")
    assert rows(frame, "patent_id", "title", "abstract", "date") == [
        ("1", 'a "b"\tc\nd', None, "2020-01-01"), ("2", "z", None, None),
    ]


@pytest.mark.parametrize("ending, pack", [(".gz", gzip.compress), (".bz2", bz2.compress)])
def test_compressed_files_with_crlf(spark, tmp_path, ending, pack):
    body = (HEADER + "1\tu\t2020-01-01\tA\tx\n").replace("\n", "\r\n")
    put(tmp_path, f"g_patent.tsv{ending}", body, pack)
    frame = read_raw(spark, str(tmp_path), "g_patent")
    assert rows(frame, "patent_id", "title", "abstract") == [("1", "A", "x")]


def test_all_part_files_are_read_in_order(spark, tmp_path):
    folder = tmp_path / "g_patent.tsv"
    put(folder, "part-1", HEADER + "3\tu\t\tC\t\n" + "4\tu\t\tD\t\n")
    put(folder, "part-0", HEADER + "1\tu\t\tA\t\n" + "2\tu\t\tB\t\n")
    frame = read_raw(spark, str(tmp_path), "g_patent")
    assert [r[0] for r in rows(frame, "patent_id")] == ["1", "2", "3", "4"]


def test_part_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "g_patent.tsv"
    put(folder, "part-0", HEADER + "1\tu\t\tA\t\n")
    put(folder, "part-1", "title\ttype\tdate\tpatent_id\tabstract\nB\tu\t\t2\t\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path), "g_patent").collect()


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, str(tmp_path), "g_patent")


def small_splits(conf, size=2000):
    conf("spark.sql.files.maxPartitionBytes", str(size))
    conf("spark.sql.files.openCostInBytes", "1")


def one_task(spark, path, names, sep="\t"):
    """What Spark's own reader makes of quoted line breaks, a file in one task."""
    frame = spark.read.csv(path, sep=sep, header=True, multiLine=True, quote='"', escape='"')
    place = F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())
    return [tuple(r) for r in frame.select(*names, place.alias("p")).orderBy("p").select(*names).collect()]


def texts(frame, *columns):
    """Rows as they were before texts for missing values became null."""
    return [tuple(x or None for x in r) for r in rows(frame, *columns)]


def test_one_file_is_read_by_many_tasks(spark, tmp_path, conf):
    lines = [f'{i}\tu\t2020-01-01\t"title ""{i}""\n\tgoes on"\tx "{i}" \n' for i in range(2000)]
    put(tmp_path, "g_patent.tsv", HEADER + "".join(lines))
    small_splits(conf)
    frame = read_raw(spark, str(tmp_path), "g_patent")
    assert frame.rdd.getNumPartitions() > 10
    columns = ["patent_id", "title", "abstract", "date"]
    assert rows(frame, *columns) == one_task(spark, f"{tmp_path}/g_patent.tsv", columns)
    assert frame.count() == 2000


CUT = '1\tu\t\t"a ""b""\n\n\tc"\t""\n\n2\tu\t\t5" pipe "z\t"\n"\n3\tu\t"\t\t"d"e\tf\ng"h\n4"\ti\n'


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20, 1000])
@pytest.mark.parametrize("crlf", [False, True])
def test_a_file_may_be_cut_at_every_byte(spark, tmp_path, conf, size, crlf):
    """With one byte for each task every byte is a border."""
    body = (HEADER + CUT).replace("\n", "\r\n") if crlf else HEADER + CUT
    put(tmp_path, "g_patent.tsv", body)
    columns = ["patent_id", "type", "date", "title", "abstract"]
    want = one_task(spark, f"{tmp_path}/g_patent.tsv", columns)
    assert len(want) == 5 and want[0][3] == 'a "b"\n\n\tc'
    small_splits(conf, size)
    frame = read_delimited(spark, f"{tmp_path}/g_patent.tsv", columns)
    assert texts(frame, *columns) == [tuple(x or None for x in r) for r in want]


def ends_within_quotes(text, sep="\t"):
    """Letter by letter: is a quote open at the end of the text?"""
    state, i = "begin", 0
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if c == '"' and text[i + 1 : i + 2] == '"':
                i += 1
            elif c == '"':
                state = "field"
        elif c in sep + "\n":
            state = "begin"
        elif state == "begin":
            state = "quoted" if c == '"' else "field"
        i += 1
    return state == "quoted"


def test_line_turns_are_those_of_letters():
    draw = random.Random(5)
    for sep in "\t,|":
        outside, inside = (p.replace("\\z", "\\Z") for p in records._patterns(sep))
        for _ in range(4000):
            line = "".join(draw.choice(f'aa"""{sep}') for _ in range(draw.randrange(14)))
            assert bool(re.search(outside, line)) == ends_within_quotes(line, sep), line
            assert bool(re.search(inside, line)) == ends_within_quotes('"\n' + line, sep), line


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_files_give_the_rows_of_one_task(spark, tmp_path, conf, end):
    draw = random.Random(len(end))
    made = 0
    while made < 60:
        body = "".join(draw.choice(["a", '"', "\t", "\n", "\n"]) for _ in range(draw.randrange(40)))
        if not ends_within_quotes(body):
            (tmp_path / f"p{made:03}.tsv").write_bytes(("a\tb\tc\n" + body).replace("\n", end).encode())
            made += 1
    want = one_task(spark, str(tmp_path), ["a", "b", "c"])
    small_splits(conf, 9)
    frame = read_delimited(spark, str(tmp_path), ["a", "b", "c"])
    assert texts(frame, "a", "b", "c") == [tuple(x or None for x in r) for r in want]


def test_long_fields_need_no_stack(spark, tmp_path):
    title = 'word ""quoted"" ' * 100_000
    put(tmp_path, "g_patent.tsv", HEADER + f'1\tu\t\t"{title}\n"\t{"x" * 300_000}\n2\tu\t\tb\t\n')
    frame = read_raw(spark, str(tmp_path), "g_patent")
    assert rows(frame.select(F.length("title").alias("n"), ORDINAL), "n") == [(1_400_001,), (1,)]


def test_a_quote_that_never_closes_raises(spark, tmp_path, conf):
    put(tmp_path, "x.tsv", 'a\tb\n1\t"open\n' + "2\tx\n" * 1000)
    for size in (100, 100_000):
        small_splits(conf, size)
        with pytest.raises(Exception, match="a record "):
            records.read_records(spark, f"{tmp_path}/x.tsv", "\t", max_record=1000).collect()


def test_places_are_the_same_in_every_cut(spark, tmp_path, conf):
    folder = tmp_path / "g_patent.tsv"
    for i in range(3):
        put(folder, f"part-{i}", HEADER + CUT)
    whole = rows(read_raw(spark, str(tmp_path), "g_patent"), ORDINAL)
    small_splits(conf, 11)
    assert rows(read_raw(spark, str(tmp_path), "g_patent"), ORDINAL) == whole
    assert len(set(whole)) == 15


def test_the_same_text_gives_the_same_rows_at_every_size(spark, tmp_path, conf):
    body = '1\tu\t2020-01-01\t"a\nb"\t""\n2\tu\t\t5" pipe\tx\n'
    put(tmp_path / "a", "g_patent.tsv", HEADER + body)
    put(tmp_path / "b", "g_patent.tsv", HEADER + body * 500)
    small_splits(conf)
    small, large = (rows(read_raw(spark, str(tmp_path / n), "g_patent"), "title") for n in "ab")
    assert large == small * 500


def test_other_columns_and_odd_headers(spark, tmp_path):
    put(tmp_path, "x.csv", "\ufeffa,A b,,c,c\n1,2,3,4,5\n6\n1,2,3,4,5,6\n")
    frame = read_delimited(spark, f"{tmp_path}/x.csv", ["a", "A b", "none"], sep=",")
    assert frame.columns == ["a", "A b", ORDINAL]
    assert rows(frame, "a", "A b") == [("1", "2"), ("6", None), ("1", "2")]


def test_turns_of_lines_in_files_are_those_of_letters(spark, tmp_path):
    draw = random.Random(7)
    lines = ["".join(draw.choice('aaé"\t') for _ in range(draw.randrange(12))) for _ in range(4000)]
    lines = [line for line in lines if line]
    put(tmp_path, "x.tsv", "\n".join(lines) + "\n")
    found = records._lines(spark, f"{tmp_path}/x.tsv", "\t").collect()
    assert len(found) == len(lines)
    for r in found:
        want = ends_within_quotes(r["line"]) + 2 * ends_within_quotes('"\n' + r["line"])
        assert r["turns"] == want, r["line"]


def test_only_one_pass_over_broken_records_looks_for_quotes(spark, tmp_path, conf):
    """Which lines cross a border is known from the first pass."""
    put(tmp_path, "x.tsv", 'a\tb\n' + '1\t"two ""x"" \nlines"\n' * 200)
    small_splits(conf, 150)
    frame = records.read_records(spark, f"{tmp_path}/x.tsv", "\t")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and len(re.findall("RLIKE|rlike", plan)) == 2
    assert sorted(r["place"] for r in frame.collect()) == [0, *range(1, 401, 2)]
