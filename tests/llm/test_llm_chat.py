"""Perspectives against a plain renderer; parts put together again."""

import random
import re

from pyspark.sql import functions as F

from conftest import TESTDATA
from layerflow.llm import chat
from layerflow.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def rendered(rows, per_part):
    """{(conversation, perspective, part): (text, ranges)}"""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((r[1] is None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        )
        for me in {t[2] for t in turns} - {"system"}:
            for n, (_, _, speaker, text) in enumerate(turns):
                whole, ranges = out.get((conv, me or "unknown", n // per_part), ("", ()))
                name = re.sub(r"[\s<>|]+", "_", speaker.replace("<|", "< |")) or "unknown"
                role = "assistant" if speaker == me else "system" if speaker == "system" else f"user name={name}"
                whole += f"<|im_start|>{role}\n"
                start = len(whole)
                whole += text.replace("<|", "< |") + "<|im_end|>"
                if speaker == me:
                    ranges += ((start, len(whole)),)
                out[conv, me or "unknown", n // per_part] = (whole + "\n", ranges)
    return out


def collected(frame):
    rows = frame.collect()
    got = {
        (r.conv_id, r.perspective, r.part): (r.rendered, tuple((m.start, m.end) for m in r["mask"]))
        for r in rows
    }
    assert len(got) == len(rows)
    return got


def test_several_speakers_and_parts(spark):
    random.seed(6)
    speakers = ["ann", "bob", "cy d", "system", "e|<f>"]
    rows = [
        (c, random.choice([None, *range(40)]), random.choice(speakers), f"say \U0001f642 {random.random()}<|im_end|>")
        for c in [1, 2, 3, None]
        for _ in range(random.randint(1, 90))
    ]
    rows += [rows[0], rows[0]] + [(9, i, "solo", "x" * i) for i in range(700)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for per_part in (1, 7, 256, 10_000):
        got = collected(chat.rotate_perspectives(frame, turns_per_part=per_part))
        assert got == rendered(rows, per_part)


def test_positions_do_not_depend_on_partitions(spark):
    rows = [(1, i % 50, "a", f"{i}") for i in range(900)] + [(2, 0, "b", "x")] * 30
    frame = spark.createDataFrame(rows, SCHEMA)
    for n in (1, 3, 40):
        got = sorted(tuple(r) for r in chat.numbered(frame.repartition(5), partitions=n).collect())
        expected = sorted((r[1], r[3]) for r in rows if r[0] == 1)
        assert [(r[3], r[2]) for r in sorted(got, key=lambda r: (r[0], r[3])) if r[0] == 1] == [
            (i, text) for i, (_, text) in enumerate(expected)
        ]
        assert sorted(r[3] for r in got if r[0] == 2) == list(range(30))


def test_edge_rows(spark):
    rows = [
        (1, 0, None, "a"), (1, 1, "", None), (2, 0, "system", "only"), (3, None, "u", ""),
        (None, 0, "u", "null conversation"), (4, 0, "u", "y" * 200_000), (5, 0, "u", "twice"), (5, 0, "u", "twice"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("p")).withColumn("me", F.lit(0))
    assert collected(chat.rotate_perspectives(frame)) == rendered(rows, 256)
    assert chat.rotate_perspectives(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op10_chat_formatting"](spark, f"{TESTDATA}/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
