"""The exit code is what a scheduler sees."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

HEADER = (
    "transaction_id,transaction_date,card_no,card_type,merchant,sub_category,category,"
    "amount,installment_months,approval_status,region"
)
GOOD = "TXN000000000{n},2024-02-03 10:00:0{n},****-****-****-1234,신용,CU,편의점,식비,1000,0,approved,서울"
BAD = GOOD.replace("****-****-****-1234", "1111-2222-3333-4444")


def run(tmp_path, line, *arguments):
    source = tmp_path / "card.csv"
    source.write_text("\n".join([HEADER, *[line.format(n=n) for n in range(1, 6)]]), "utf-8")
    command = [sys.executable, "-m", "tillwise", *arguments, "--input", str(source)]
    shared = f"--conf spark.checkpoint.dir={tmp_path}/shared --conf spark.ui.enabled=false"
    environment = {**os.environ, "PYSPARK_SUBMIT_ARGS": f"{shared} pyspark-shell"}
    return subprocess.run(
        command, cwd=ROOT, env=environment, capture_output=True, text=True, timeout=300
    )


@pytest.mark.parametrize("line, code, verdict", [(GOOD, 0, "PASS"), (BAD, 1, "FAIL")])
def test_quality_exit_code(tmp_path, line, code, verdict):
    done = run(tmp_path, line, "quality")
    assert (done.returncode, done.stdout.split()) == (code, [verdict]), done.stderr


def test_output_is_required(tmp_path):
    assert run(tmp_path, GOOD, "etl").returncode == 2
