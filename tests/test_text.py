"""CSV and JSON lines as gate sources (S2): typed by the gate, broken lines kept."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tablegate.operators.contract import CORRUPT, clean, gate, gate_counts, rejected
from tablegate.plans import job
from tablegate.plans.check import compare
from tablegate.plans.contracts import CUSTOMER_CONTRACT, TRANSACTION_CONTRACT
from tablegate.sources.sinks import write_split
from tablegate.sources.text import read_text
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.integration


def write(folder, files):
    os.makedirs(folder)
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n")
    return folder


HEADER = "transaction_id,customer_id,amount,date,note"


@pytest.fixture
def csv(scratch):
    return write(
        scratch + "/csv",
        {
            "a.csv": [HEADER, '1,2,3.50,2025-01-01,"a, ""b"""', "2,x,3,2025-01-01,", "3,4", "", "4,5,6,2025-01-01,n,more"],
            "b.csv": [HEADER, '5,"6,7,2025-01-01,n', "6,7,nan,2025-01-02,é", ",7,1,2025-1-2, pad ", "8,9,,2025-01-01,x"],
        },
    )


def test_every_line_is_clean_or_rejected(spark, csv):
    rows = gate(read_text(spark, csv, TRANSACTION_CONTRACT), TRANSACTION_CONTRACT)
    good = {r.transaction_id: r for r in clean(rows).collect()}
    assert sorted(good) == [1, 6] and good[1].amount == 3.5 and good[1].note == 'a, "b"' and good[6].note == "é"
    assert CORRUPT not in clean(rows).columns
    bad = [(r[CORRUPT], r.transaction_id, r.rejection_reason) for r in rejected(rows).collect()]
    lines = {b[0]: b[2] for b in bad if b[0]}
    assert lines == dict.fromkeys(["3,4", "4,5,6,2025-01-01,n,more", '5,"6,7,2025-01-01,n'], f"{CORRUPT}: line cannot be read")
    assert {b[1]: b[2] for b in bad if not b[0]} == {
        "2": "customer_id: must be of type bigint",
        None: "transaction_id: is required",
        "8": "amount: is required",
    }
    # Counting reads few columns; what is broken stays broken.
    assert gate_counts(rows).first() == (2, 6)


def test_split_keeps_broken_lines(spark, csv, scratch):
    split = write_split(gate(read_text(spark, csv, TRANSACTION_CONTRACT), TRANSACTION_CONTRACT), scratch + "/split", "transactions")
    assert (split.clean_rows, split.rejected_rows) == (2, 6) and CORRUPT not in split.clean.columns
    assert split.rejected.where(F.col(CORRUPT).isNotNull()).count() == 3


def test_headers_name_the_fields(spark, scratch):
    path = write(scratch + "/h", {"a.csv": ["date;amount;customer_id", "2025-01-01;1;2"]})
    rows = gate(read_text(spark, path, TRANSACTION_CONTRACT, sep=";"), TRANSACTION_CONTRACT)
    assert [r.rejection_reason for r in rejected(rows).collect()] == ["transaction_id: is required"]
    twice = write(scratch + "/t", {"a.csv": ["date,Date", "1,2"]})
    with pytest.raises(Exception, match="(?i)header"):
        read_text(spark, twice, TRANSACTION_CONTRACT).collect()
    with pytest.raises(ValueError, match="more than once"):
        read_text(spark, twice, TRANSACTION_CONTRACT, columns=["date", "Date"])
    other = write(scratch + "/o", {"a.csv": [HEADER, "1,2,3,2025-01-01,n"], "b.csv": ["customer_id,transaction_id,amount,date,note", "1,2,3,2025-01-01,n"]})
    with pytest.raises(Exception, match="(?i)header"):
        read_text(spark, other, TRANSACTION_CONTRACT).collect()


def test_json_lines(spark, scratch):
    rows = [
        '{"customer_id": 1, "name": "Ana", "email": "a@b.co", "country": "X", "more": {"a": 1.50}}',
        '{"customer_id": "2", "name": " ", "email": "a@b.co", "country": null}',
        '{"customer_id": 3, "name": ',
        "[1, 2]",
        "",
        '{"name": "Bo", "email": ["x"], "country": "Y", "customer_id": 1.0}',
    ]
    path = write(scratch + "/json", {"a.json": rows})
    gated = gate(read_text(spark, path, CUSTOMER_CONTRACT, "json", columns=["more"]), CUSTOMER_CONTRACT)
    assert [(r.customer_id, r.name, r.more) for r in clean(gated).collect()] == [(1, "Ana", '{"a": 1.50}')]
    bad = {r[CORRUPT] or r.customer_id: r.rejection_reason for r in rejected(gated).collect()}
    assert bad == {
        "2": "name: must be a non-empty string; country: is required",
        rows[2]: f"{CORRUPT}: line cannot be read",
        "[1, 2]": f"{CORRUPT}: line cannot be read",
        "1.0": "email: must be a valid e-mail address",
    }


def test_empty_sources(spark, scratch):
    only = write(scratch + "/e", {"a.csv": [HEADER]})
    assert gate(read_text(spark, only, TRANSACTION_CONTRACT), TRANSACTION_CONTRACT).count() == 0
    with pytest.raises(ValueError, match="known"):
        read_text(spark, only, TRANSACTION_CONTRACT, "xml")


def test_twins(spark):
    for name, got in compare(spark, SF_SMALL, ["gate_text_clean", "gate_text_rejected", "totals_as_doubles"]).items():
        assert got["values_match"], name


def test_audit_of_csv_files_from_the_command_line(spark, csv, scratch, capsys):
    customers = write(scratch + "/c", {"c.csv": ["customer_id|name|email|country|note", "2|Ana|a@b.co|X|n", "7|Bo|b@b.co|Y|n", "9|Cy"]})
    files = write(scratch + "/t", {"t.csv": [HEADER.replace(",", "|"), "1|2|3.50|2025-01-01|n", "2|7|1|2025-01-01|n", "3|7|1"]})
    code = job.main(["--format", "csv", "--option", "sep=|", "--customers", customers, "--transactions", files, "--output", scratch + "/out"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # The broken line's amount is in the raw total only, so the totals differ.
    assert code == 2 and out["rejected"] == {"customers": 1, "transactions": 1} and out["clean"] == {"customers": 2, "transactions": 2}
