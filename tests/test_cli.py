from __future__ import annotations

import os
import subprocess
import sys

from tests.conftest import CLEAN, write_dat

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_report_over_dat_files(tmp_path):
    folder = write_dat(tmp_path / "dat", CLEAN)
    out = subprocess.run(
        [sys.executable, "-m", "rateweave", "--dat", folder, "report", "--master", "local[2]"],
        cwd=REPO,
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "== cohort_top_titles_18" in out.stdout
    assert "|Alpha (1990)|2  |" in out.stdout
    assert "== latest_reviews" in out.stdout


def test_convert_then_query_the_parquet_copy(tmp_path):
    folder = write_dat(tmp_path / "dat", CLEAN)
    out = str(tmp_path / "pq")
    base = [sys.executable, "-m", "rateweave", "--master", "local[2]"]
    step = subprocess.run(base + ["--dat", folder, "convert", "--out", out], cwd=REPO, capture_output=True, text=True)
    assert step.returncode == 0, step.stderr[-2000:]
    assert "wrote 7 ratings" in step.stdout
    shown = subprocess.run(base + ["--converted", out, "most_popular"], cwd=REPO, capture_output=True, text=True)
    assert shown.returncode == 0, shown.stderr[-2000:]
    assert "|10     |3  |" in shown.stdout


def test_convert_options(tmp_path):
    folder = write_dat(tmp_path / "dat", CLEAN)
    with open(f"{folder}/occupations.dat", "wb") as handle:
        handle.write("4:: étudiant\n".encode("latin-1"))
    out = str(tmp_path / "pq")
    command = [sys.executable, "-m", "rateweave", "--master", "local[2]", "--dat", folder, "convert", "--out", out]
    options = ["--encoding", "ISO-8859-1", "--no-trim"]
    first = subprocess.run(command + options, cwd=REPO, capture_output=True, text=True)
    assert first.returncode == 0, first.stderr[-2000:]
    again = subprocess.run(command + options, cwd=REPO, capture_output=True, text=True)
    assert again.returncode != 0 and "already exists" in again.stderr
    third = subprocess.run(command + options + ["--overwrite"], cwd=REPO, capture_output=True, text=True)
    assert third.returncode == 0, third.stderr[-2000:]
    import pyarrow.dataset as ds

    assert ds.dataset(f"{out}/occupations").to_table()["OccupationName"].to_pylist() == [" étudiant"]
