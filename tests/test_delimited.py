"""The ``::`` reader on dirty input (FIXTURES.md section 3)."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from rateweave import schemas
from rateweave.sources.delimited import accepted, read_delimited, read_lines, rejected
from rateweave.sources.parquet import convert_to_parquet
from tests.conftest import CLEAN, rows, write_dat

ERRORS = (PySparkException, Py4JJavaError)


def _read(spark, tmp_path, name, lines, schema, **options):
    folder = write_dat(tmp_path / name, {f"{name}.dat": lines})
    return read_delimited(spark, f"{folder}/{name}.dat", schema, **options)


def test_trailing_empty_field_is_kept(spark, tmp_path):
    df = _read(spark, tmp_path, "users", ["5::M::18::4::"], schemas.USERS)
    assert rows(df) == [("5", "M", "18", "4", "")]


def test_short_row_strict_fails(spark, tmp_path):
    df = _read(spark, tmp_path, "users", ["1::F::18::4::1", "6::M::18"], schemas.USERS)
    with pytest.raises(ERRORS, match="expected 5 fields"):
        df.collect()


def test_short_row_permissive_rejects(spark, tmp_path):
    df = _read(spark, tmp_path, "users", ["1::F::18::4::1", "6::M::18"], schemas.USERS, mode="permissive")
    assert rows(accepted(df)) == [("1", "F", "18", "4", "1")]
    bad = rejected(df).collect()
    got = [(r["UserID"], r["Age"], r["OccupationID"], r["_reject"], r["_line"]) for r in bad]
    assert got == [("6", "18", None, "expected 5 fields", "6::M::18")]


def test_extra_field_is_ignored(spark, tmp_path):
    df = _read(spark, tmp_path, "users", ["7::M::18::4::1::x"], schemas.USERS)
    assert rows(df) == [("7", "M", "18", "4", "1")]


def test_blank_line_dropped_when_permissive_and_fatal_when_strict(spark, tmp_path):
    lines = ["1::10::5::1000", "", "2::10::4::1002"]
    ok = _read(spark, tmp_path, "ratings", lines, schemas.RATINGS, mode="permissive")
    assert rows(accepted(ok), "UserID") == [("1",), ("2",)]
    assert rejected(ok).count() == 0
    strict = _read(spark, tmp_path, "ratings2", lines, schemas.RATINGS)
    with pytest.raises(ERRORS, match="expected 4 fields"):
        strict.collect()


def test_bad_number(spark, tmp_path):
    lines = ["1::10::five::1000", "1::20::3::1001"]
    with pytest.raises(ERRORS, match="Rating is not a double"):
        _read(spark, tmp_path, "ratings", lines, schemas.RATINGS).collect()
    df = _read(spark, tmp_path, "ratings2", lines, schemas.RATINGS, mode="permissive")
    assert rows(accepted(df), "MovieID", "Rating") == [("20", 3.0)]
    assert [r["_reject"] for r in rejected(df).collect()] == ["bad value: Rating"]


def test_padding_is_trimmed_like_the_jvm(spark, tmp_path):
    df = _read(spark, tmp_path, "ratings", [" 1 ::\t10 :: 5::1000\r"], schemas.RATINGS)
    assert rows(df) == [("1", "10", 5.0, "1000")]


def test_untrimmed_mode_keeps_padding(spark, tmp_path):
    df = _read(spark, tmp_path, "users", [" 1 ::M::18::4::z"], schemas.USERS, trim=False)
    assert rows(df, "UserID") == [(" 1 ",)]


def test_quotes_are_plain_characters(spark, tmp_path):
    df = _read(spark, tmp_path, "movies", ['40::The "Q, R" (1999)::Drama'], schemas.MOVIES)
    assert rows(df, "Title") == [('The "Q, R" (1999)',)]


def test_separator_runs_split_left_to_right(spark, tmp_path):
    df = _read(spark, tmp_path, "movies", ["1:::x::y", "2::a\u0001b::c"], schemas.MOVIES)
    assert rows(df) == [("1", ":x", "y"), ("2", "a\u0001b", "c")]


def test_last_line_without_newline(spark, tmp_path):
    lines = ["0::other", "1::academic/educator"]
    folder = write_dat(tmp_path / "occ", {"occupations.dat": lines}, newline_at_end=False)
    df = read_delimited(spark, f"{folder}/occupations.dat", schemas.OCCUPATIONS)
    assert rows(df) == [("0", "other"), ("1", "academic/educator")]


def test_other_encodings(spark, tmp_path):
    path = tmp_path / "movies.dat"
    path.write_bytes("1::Café (1990)::Drama\n".encode("latin-1"))
    df = read_delimited(spark, str(path), schemas.MOVIES, encoding="ISO-8859-1")
    assert rows(df, "Title") == [("Café (1990)",)]


@pytest.mark.parametrize("encoding, text", [("windows-1252", "Zoë’s – €5"), ("ISO-8859-15", "Œuvre €"), ("ISO-8859-1", "Ünï"), ("utf8", "日本")])
def test_single_byte_encodings(spark, tmp_path, encoding, text):
    path = tmp_path / "movies.dat"
    path.write_bytes(f"1::{text}::D\n2::a\u0001b::D\n".encode(encoding))
    df = read_delimited(spark, str(path), schemas.MOVIES, encoding=encoding)
    assert rows(df, "Title") == sorted([(text,), ("a\u0001b",)])


def test_multi_byte_encodings_are_refused(spark, tmp_path):
    (tmp_path / "m.dat").write_bytes(b"")
    for encoding in ("utf-16", "shift_jis", "gbk"):
        with pytest.raises(ValueError, match="UTF-8"):
            read_delimited(spark, str(tmp_path / "m.dat"), schemas.MOVIES, encoding=encoding)


@pytest.mark.parametrize("encoding", ["utf-8", "ISO-8859-1"])
def test_blank_lines_are_the_same_in_every_encoding(spark, tmp_path, encoding):
    path = tmp_path / "occ.dat"
    path.write_bytes(b"0::other\n\n1::student\n")
    strict = read_delimited(spark, str(path), schemas.OCCUPATIONS, encoding=encoding)
    with pytest.raises(ERRORS, match="expected 2 fields"):
        strict.collect()
    good = accepted(read_delimited(spark, str(path), schemas.OCCUPATIONS, encoding=encoding, mode="permissive"))
    assert rows(good) == [("0", "other"), ("1", "student")]


def test_rare_white_space_is_trimmed_after_the_common(spark, tmp_path):
    df = _read(spark, tmp_path, "occ", [" \t\u0002 4 \u000b::\u0001 x y \u001f\t"], schemas.OCCUPATIONS)
    assert rows(df) == [("4", "x y")]


def test_bad_time_sorts_last_instead_of_failing(spark, tmp_path):
    from rateweave.plans import analyses as A
    from rateweave.sources.tables import accepted_tables, load_dat_tables

    folder = write_dat(tmp_path / "times", {**CLEAN, "ratings.dat": ["1::10::4::abc", "2::10::4::7", "3::10::4::20"]})
    t = accepted_tables(load_dat_tables(spark, folder, mode="permissive"))
    assert [r["UserID"] for r in A.latest_reviews(t).collect()] == ["3", "2", "1"]


def test_converted_movies_keep_file_order(spark, tmp_path):
    from rateweave.plans import analyses as A
    from rateweave.sources.tables import load_dat_tables

    folder = write_dat(tmp_path / "dat", {**CLEAN, "movies.dat": ["10::Zeta::D", "20::Beta::D", "10::Alpha::D"]})
    for mode in ("strict", "permissive"):
        converted = convert_to_parquet(spark, folder, str(tmp_path / mode), mode=mode)
        original = load_dat_tables(spark, folder, movie_seq="seq")
        for t in (converted, original):
            assert rows(A.titles_last_wins(t.movies, "seq")) == [("10", "Alpha"), ("20", "Beta")]
            assert ("10", "Alpha") in rows(A.cohort_top_movies_semi(t, "18", seq="seq"), "MovieID", "Title")


def test_conversion_refuses_to_overwrite(spark, tmp_path):
    folder = write_dat(tmp_path / "dat", CLEAN)
    convert_to_parquet(spark, folder, str(tmp_path / "pq"))
    with pytest.raises(PySparkException, match="already exists"):
        convert_to_parquet(spark, folder, str(tmp_path / "pq"))
    assert convert_to_parquet(spark, folder, str(tmp_path / "pq"), overwrite=True).ratings.count() == 7


def test_file_order_sequence(spark, tmp_path):
    folder = write_dat(tmp_path / "m", {"movies.dat": ["10::Alpha::D", "10::Alpha copy::D", "20::Beta::D"]})
    lines = read_lines(spark, f"{folder}/movies.dat", seq_col="seq")
    ordered = [r["value"] for r in lines.orderBy("seq").collect()]
    assert ordered == ["10::Alpha::D", "10::Alpha copy::D", "20::Beta::D"]


def test_convert_to_parquet(spark, tmp_path):
    folder = write_dat(tmp_path / "dat", CLEAN)
    tables = convert_to_parquet(spark, folder, str(tmp_path / "pq"))
    assert tables.ratings.count() == len(CLEAN["ratings.dat"])
    assert tables.ratings.schema == schemas.RATINGS
    assert rows(tables.occupations) == [("4", "student"), ("7", "manager"), ("9", "homemaker")]


def test_permissive_conversion_keeps_rejects_aside(spark, tmp_path):
    from rateweave.sources.tables import accepted_tables, load_dat_tables

    files = {**CLEAN, "ratings.dat": CLEAN["ratings.dat"] + ["9::10::five::1", "9::10"]}
    folder = write_dat(tmp_path / "dirty", files)
    tables = convert_to_parquet(spark, folder, str(tmp_path / "pq"), mode="permissive")
    assert tables.ratings.count() == len(CLEAN["ratings.dat"])
    bad = spark.read.parquet(str(tmp_path / "pq" / "_rejects" / "ratings"))
    got = sorted((r["_reject"], r["_line"]) for r in bad.collect())
    assert got == [("bad value: Rating", "9::10::five::1"), ("expected 4 fields", "9::10")]
    clean = accepted_tables(load_dat_tables(spark, folder, mode="permissive"))
    assert "_reject" not in clean.ratings.columns and clean.ratings.count() == len(CLEAN["ratings.dat"])


def test_strict_mode_does_not_depend_on_ansi(spark, tmp_path):
    from tests.test_plans import conf

    with conf(spark, spark__sql__ansi__enabled="false"):
        df = _read(spark, tmp_path, "ratings", ["1::10::five::1000"], schemas.RATINGS)
        with pytest.raises(ERRORS, match="Rating is not a double"):
            df.collect()
        short = _read(spark, tmp_path, "users", ["6::M::18"], schemas.USERS)
        with pytest.raises(ERRORS, match="expected 5 fields"):
            short.collect()


def test_conversion_clusters_ratings_by_movie_within_files(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    lines = [f"{u}::{m}::{(u + m) % 5 + 1}::{1000 + u}" for u in range(1, 40) for m in (30, 10, 20)]
    folder = write_dat(tmp_path / "dat", {**CLEAN, "ratings.dat": lines})
    convert_to_parquet(spark, folder, str(tmp_path / "pq"))
    for path in glob.glob(str(tmp_path / "pq" / "ratings" / "*.parquet")):
        movies = pq.read_table(path, columns=["MovieID"]).column("MovieID").to_pylist()
        assert movies == sorted(movies)
