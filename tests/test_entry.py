import re
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_names():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert {f"p{n}_found" for n in (1, 2, 3, 5)} <= set(q)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "mark_spread" in df.columns


def test_rest_does_not_import_llm():
    for p in (ROOT / "tallyforge").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"tallyforge\.llm|from \.+llm", p.read_text()), p


def test_no_local_checkpoints():
    for p in (ROOT / "tallyforge").rglob("*.py"):
        assert "localCheckpoint" not in p.read_text()
