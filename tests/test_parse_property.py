"""Property test: id-list parsing against a small Python model."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from adinsight.functions.columns import id_list
from adinsight.sources.local import local_table

INT64_MAX = 2 ** 63 - 1


def model(cell):
    """Reference semantics: NA / blank -> None (no filter); pipes are commas;
    tokens trimmed of spaces; non-integers dropped; first occurrence kept."""
    if cell is None or cell.strip(" ") in ("", "NA"):
        return None
    out = []
    for tok in cell.strip(" ").replace("|", ",").split(","):
        t = tok.strip(" ")
        body = t[1:] if t[:1] in "+-" and len(t) > 1 else t
        if body.isdigit() and body.isascii():
            v = int(t)
            if -INT64_MAX - 1 <= v <= INT64_MAX and v not in out:
                out.append(v)
    return out


token = st.one_of(
    st.integers(min_value=0, max_value=30).map(str),
    st.integers(min_value=-5, max_value=5).map(lambda v: f"{v:+d}"),
    st.just(str(2 ** 63)),           # out of range
    st.sampled_from(["", " ", "NA", "abc", "1a", "007"]),
    st.integers(min_value=0, max_value=9).map(lambda v: f"  {v} "),
)
cell = st.one_of(
    st.none(),
    st.sampled_from(["NA", " NA ", ""]),
    st.lists(token, min_size=1, max_size=6).flatmap(
        lambda toks: st.lists(st.sampled_from([",", "|"]), min_size=len(toks) - 1,
                              max_size=len(toks) - 1).map(
            lambda seps: "".join(t + s for t, s in zip(toks, seps + [""])))),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(cell, min_size=20, max_size=60))
def test_id_list_matches_model(spark, cells):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("c", T.StringType())])
    df = local_table(spark, list(enumerate(cells)), schema)
    got = {r["i"]: r["ids"] for r in df.select("i", id_list("c").alias("ids")).collect()}
    for i, c in enumerate(cells):
        assert got[i] == model(c), (c, got[i], model(c))
