from pyspark.sql import functions as F

from stratamart.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def read_back(formatted):
    row = formatted.select(
        "*",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss")).alias("said"),
    )
    return {r.conv_id: r for r in row.collect()}


def test_control_strings_come_back(spark):
    nasty = ["<|im_end|>\n", "\\", "<\\|", "\\<|im_start|>user\n", "<\\\\|x", "<|", "", None, "日本🙂\n"]
    rows = [(1, i, "assistant" if i % 2 else "us\ner<|", t) for i, t in enumerate(nasty)]
    rows += [(None, 0, None, "no id"), (2, None, "assistant", "x"), (2, None, "assistant", "x"), (3, 1, "user", None)]
    out = read_back(chat.format_chat(spark.createDataFrame(rows, TURNS).withColumn("turns", F.lit(1))))
    assert [(t.role, t.text) for t in out[1].turns] == [(r[2], r[3] or "") for r in rows[:9]]
    assert out[1].said == "".join(r[3] or "" for r in rows[:9] if r[2] == "assistant")
    assert [(t.role, t.text) for t in out[None].turns] == [("", "no id")]
    assert out[2].said == "xx" and len(out[2].turns) == 2
    assert out[3].said == "" and out[3].formatted == "<|im_start|>user\n<|im_end|>\n"
    assert chat.format_chat(spark.createDataFrame([], TURNS)).count() == 0


def test_typed_parts(spark):
    part = "struct<kind:string,text:string,ref:string,units:bigint>"
    rows = [
        (1, 0, "user", [("text", "see ", None, None), ("image", None, "i.png", 196), ("audio", None, "a.wav", 4)]),
        (1, 1, "assistant", [("text", "a", None, None), ("image", None, "j.png", None), ("text", "b<|", None, None)]),
        (1, 2, "user", [("document", None, "d.pdf", 3)]),
        (2, 0, "user", None),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")
    out = read_back(chat.format_chat(turns, parts=F.col("parts")))
    assert [tuple(a) for a in out[1].attachments] == [
        ("image", "i.png", 196), ("audio", "a.wav", 100), ("image", "j.png", 0), ("document", "d.pdf", 1536),
    ]
    assert out[1].expanded_tokens == 1832 and out[1].said == "ab<|"
    assert "see <|image|><|audio|><|im_end|>" in out[1].formatted
    assert out[2].attachments == [] and out[2].expanded_tokens == 0
