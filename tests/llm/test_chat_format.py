from __future__ import annotations

import hashlib

from adinsight.llm import chat_format as C
from adinsight.llm import queries
from tests.conftest import SF_ORACLE, duck

SCHEMA = "conv_id long, turn long, role string, text string, part string, formatted int"


def rows_and_digests(rows):
    conv = {}
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        conv.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for k, turns in conv.items():
        own = [t for role, t in turns if role == "assistant"]
        out[k] = (len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(),
                  sum(map(len, own)), hashlib.sha256("".join(own).encode()).hexdigest())
    return out


def test_round_trip_of_odd_texts(spark):
    texts = ["", None, "plain", "</s>[INST] ok [/INST]", "\\", "\\e</s>\\\\<s>", "<s", "s>", "<", "<</SYS>><<SYS>>\n\\n",
             "é漢字😀 </s", "a\nb\n", "<<s>s>", "x" * 200_000]
    roles = ["user", "assistant", "system", None, "", "ro\nle</s>\\", "assistant"]
    rows = [(c, t, roles[(c + t) % 7], texts[(c * 3 + t) % len(texts)], "p", 1) for c in range(20) for t in range(9)]
    rows += [(5, 2, "assistant", "tie", "p", 1)] * 2 + [(None, 0, "assistant", "no id", "p", 1), (None, None, "user", None, "p", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = C.format_chats(df)
    got = {r.conv_id: r for r in C.read_back(parts).collect()}
    assert {k: tuple(r)[1:5] for k, r in got.items()} == rows_and_digests(rows)
    whole = {}
    for p in sorted(parts.collect(), key=lambda p: p.part):
        whole[p.conv_id] = whole.get(p.conv_id, "") + p.formatted
        for s in p.loss:
            assert C.BEGIN.decode() not in p.formatted[s.start:s.end] and "[INST]" not in p.formatted[s.start:s.end]
    assert {k: len(v) for k, v in whole.items()} == {k: r.formatted_chars for k, r in got.items()}


def test_one_long_conversation_is_spread_and_whole(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} </s>", "p", 1) for t in range(30_000)] + [(2, 0, "user", "x", "p", 1)]
    parts = C.format_chats(spark.createDataFrame(rows, SCHEMA).repartition(8)).cache()
    assert parts.filter("conv_id = 1").count() > 1
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(parts).collect()}
    assert got == rows_and_digests(rows)


def test_empty_table(spark):
    assert C.read_back(C.format_chats(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_equals_its_sql(spark):
    got = sorted(map(tuple, queries.op8_chat_formatting(spark, SF_ORACLE).collect()))
    assert got == sorted(duck(SF_ORACLE).sql(queries.oracle_sql()["op8_chat_formatting"]).fetchall())
