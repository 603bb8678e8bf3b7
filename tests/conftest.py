import contextlib
import io
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from blotter.session import build_session

    return build_session(master="local[*]", app="blotter-tests", shuffle_partitions=8)


def _explain(df, mode: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def final_plan(df) -> str:
    """Run ``df`` and return its adaptive plan as executed (the part before
    the initial plan); ``explain`` shows it once the DataFrame has run."""
    df.collect()
    return _explain(df, "simple").split("== Initial Plan ==")[0]


plan_text = final_plan


def formatted_plan(df) -> str:
    """The plan as planned, before execution."""
    return _explain(df, "formatted")
