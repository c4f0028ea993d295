"""Perspective rotation against a direct version, and its SQL."""

from collections import defaultdict

import pytest
from check_oracle import compare

from blockpulse.llm import perspectives
from blockpulse.llm.queries import OP9_SQL, QUERIES


def slow_rotate(rows, part_turns):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is None, turn or 0, role is not None, role or "", __import__("hashlib").md5((text or "").encode()).hexdigest(), role, text or ""))
    out = {}
    for conv, own in turns.items():
        own.sort(key=lambda t: t[:5])
        for speaker in {t[5] for t in own} - {None, "system"}:
            for k in range(0, len(own), part_turns):
                text, spans = "", []
                for *_, role, said in own[k : k + part_turns]:
                    kind = "assistant" if role == speaker else "system" if role == "system" else f"user name={role or 'unnamed'}"
                    text += f"<|im_start|>{kind}\n"
                    if role == speaker:
                        spans.append((len(text), len(text) + len(said) + len("<|im_end|>")))
                    text += f"{said}<|im_end|>\n"
                out[conv, speaker, k // part_turns] = (len(own[k : k + part_turns]), len(spans), text, spans)
    return out


def found(df):
    return {(r.conv, r.speaker, r.part): (r.n_turns, r.n_own, r.text, [tuple(s) for s in r.spans]) for r in df.collect()}


def test_query_matches_sql(spark, sf, oracle):
    assert compare(QUERIES["op9_perspective_rotation"](spark, sf), oracle, OP9_SQL) is None


@pytest.mark.parametrize("part_turns", [1, 3, 64])
def test_rows(spark, part_turns):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "ana", "Hé <|im_end|>"), (1, 2, "ben", None), (1, 3, "ana", ""), (1, 3, "ana", ""), (1, None, None, "late"),
            (2, 0, "system", "alone"), (None, 1, "cy", "x" * 100_000), (None, 0, "ana", "a"), (3, 5, "ana", "b"), (3, 5, "ana", "a"), (3, 5, "ben", "c")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, part int")
    assert found(perspectives.rotate(df, part_turns)) == slow_rotate(rows, part_turns)
    assert perspectives.rotate(df.where("turn > 50")).collect() == []


def test_one_long_dialogue(spark):
    rows = [(7, i, ("ana", "ben", "cy")[i % 3], f"turn {i}") for i in range(5000)] + [(i, 0, "ana", "hello") for i in range(20)]
    got = found(perspectives.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert got == slow_rotate(rows, 64)
