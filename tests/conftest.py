from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rateweave.session import build_session  # noqa: E402
from rateweave.sources.tables import Tables, load_dat_tables  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=8, app_name="rateweave-tests")
    # Tests own their session, so they may name the shared folder themselves.
    if not session.sparkContext.getConf().get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rateweave-tests-"))
    yield session
    session.stop()


# The clean fixture of FIXTURES.md section 2 (synthetic rows).
CLEAN = {
    "users.dat": ["1::F::18::4::10001", "2::M::18::7::10002", "3::M::25::4::10003", "4::F::25::9::10004"],
    "movies.dat": ["10::Alpha (1990)::Drama", "20::Beta (1991)::Action|Crime", "30::Gamma (1992)::Comedy"],
    "occupations.dat": ["4::student", "7::manager", "9::homemaker"],
    "ratings.dat": [
        "1::10::5::1000",
        "1::20::3::1001",
        "2::10::4::1002",
        "2::30::2::1002",
        "3::10::3::1003",
        "3::20::5::1003",
        "4::30::5::1004",
    ],
}


def write_dat(folder, files: dict[str, list[str]], newline_at_end: bool = True) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, lines in files.items():
        text = "\n".join(lines) + ("\n" if newline_at_end and lines else "")
        with open(os.path.join(folder, name), "w", encoding="utf-8") as handle:
            handle.write(text)
    return str(folder)


def dat_tables(spark, folder, files: dict[str, list[str]], **options) -> Tables:
    merged = {**CLEAN, **files}
    return load_dat_tables(spark, write_dat(folder, merged), **options)


@pytest.fixture()
def clean_tables(spark, tmp_path) -> Tables:
    return dat_tables(spark, tmp_path / "clean", {})


def _null_last(row):
    return tuple((value is None, 0 if value is None else value) for value in row)


def rows(df, *cols):
    """Sorted plain tuples of the chosen columns (NULLs sort last)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_null_last)
