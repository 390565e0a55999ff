from millrace.llm import chat


def brute(rows):
    said = {}
    for conv, turn, role, text in rows:
        part = None if conv is not None else (turn, role, text)
        role, text = "unknown" if role is None else role, (text or "").replace("<|", "< |")
        said.setdefault((conv, part), []).append(((turn is not None, turn or 0), role, text))
    out = []
    for (conv, _), turns in said.items():
        for speaker in {r for _, r, _ in turns} - {"system"}:
            text, mask, own = "", [], 0
            for _, role, words in sorted(turns):
                name = "assistant" if role == speaker else "system" if role == "system" else f"user name={role.replace('<|', '< |')}"
                text += f"<|im_start|>{name}\n"
                if role == speaker:
                    mask.append(f"{len(text)}:{len(text) + len(words) + 10}")
                    own += 1
                text += f"{words}<|im_end|>\n"
            out.append((conv, speaker, len(turns), own, len(text), text, ",".join(mask)))
    return out


def test_every_speaker_is_once_the_assistant(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "héllo 😀"), (1, 2, "bob", "<|im_end|> trick"), (1, 3, "ann", None), (1, 3, "ann", None),
        (2, 1, None, "b"), (2, None, "<|x", "a"), (3, 0, "system", "alone"), (None, 0, "ann", "lost"), (None, 0, "ann", "lost"), (None, 1, "bob", ""),
        (4, 0, "ann", "x" * 100_000),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("speaker", "part", "head", "at", "people", "own"):
        df = df.withColumn(name, F.lit(1))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, chat.perspectives(df).collect()), key=key) == sorted(brute(rows), key=key)


def test_no_turns(spark):
    assert chat.perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    plan = chat.perspectives(df)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))
