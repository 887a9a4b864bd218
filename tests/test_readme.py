"""The README's quick-start block runs as written."""

import contextlib
import io
import os
import re


def test_quick_start_block_runs(spark):
    readme = open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                               "README.md")).read()
    block = re.search(r"## Quick start\s+```python\n(.*?)```", readme, re.S).group(1)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        exec(compile(block, "README.md", "exec"), {})
    text = out.getvalue()
    assert "2024-01-01" in text and "54" in text  # the sf0.01 flagship counts
