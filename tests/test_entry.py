"""The driver contract without the optional subpackage."""

from __future__ import annotations

import subprocess
import sys

from tests.conftest import ROOT


def test_the_reports_register_without_a_library_of_the_optional_part():
    code = ("import sys; sys.modules['tiktoken'] = None; sys.path.insert(0, %r); import __spark_entry__ as e; "
            "q = e.queries(); print(len(q), sorted(q) == sorted(e.oracle_sql()))" % ROOT)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["42", "True"], out.stderr[-800:]
