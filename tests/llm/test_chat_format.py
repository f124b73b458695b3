import hashlib

from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from reqlens.llm import chat_format as C
from tests.conftest import SF01
from tests.oracle_compare import compare, duckdb_connection

CONTROL = ["<|end|>", "<|turn|>user<|says|>", "</s>", "<s>[INST] x [/INST]", "<\\|end|>", "<\\\\|", "[\\/INST]", "[[INST]", "<", "\\", "a\nb", "<|image|>", "", "é😀"]
TYPED = f"conv_id long, turn long, role string, parts {C.PARTS}"


def part(kind, text=None, ref=None, width=None, height=None, millis=None, pages=None):
    return (kind, text, ref, width, height, millis, pages)


def test_every_text_comes_back(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in CONTROL for r in ("user", "assistant", "<|end|>"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = C.conversations(C.render_turns(df)).first()
    assert C.read_turns(formatted["formatted"]) == [(r, [t]) for _, _, r, t in rows]
    said = [formatted["formatted"][s["start"] : s["start"] + s["length"]] for s in formatted["loss"]]
    assert [C.unescaped(t) for t in said] == [t for _, _, r, t in rows if r == "assistant"]
    bare = formatted["formatted"].replace(C.TURN, "").replace(C.SAYS, "").replace(C.END, "")
    assert not any(c in bare for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def test_typed_parts(spark):
    parts = [
        part("text", "see <"), part("text", "|end|> it"), part("image", ref="a.png", width=28, height=15), part("text", "and"),
        part("audio", ref="b.wav", millis=81), part("document", ref="c.pdf", pages=3), part("image"), part("video", "odd"), part(None),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [part("text", "ok"), part("image", ref="d.png", width=1, height=1), part("text", "fine")]), (1, 2, "user", None), (2, 0, None, [])]
    got = {r["conv_id"]: r for r in C.conversations(C.render_turns(spark.createDataFrame(rows, TYPED))).collect()}
    one = got[1]
    assert C.read_turns(one["formatted"]) == [
        ("user", ["see <", "|end|> it", "and", "", "", "odd", ""]),
        ("assistant", ["ok", "fine"]),
        ("user", [""]),
    ]
    assert one["formatted"].startswith("<|turn|>user<|says|>see <<|part|>|end|> it<|image|>and<|audio|><|document|><|image|>odd<|part|><|end|>")
    assert [tuple(a) for a in one["attachments"]] == [("image", "a.png", 4), ("audio", "b.wav", 3), ("document", "c.pdf", 768), ("image", None, 1), ("image", "d.png", 1)]
    assert [one["formatted"][s["start"] : s["start"] + s["length"]] for s in one["loss"]] == ["ok", "fine"]
    words = 2 + 5 + 1 + 1 + 2  # see <, |end|> it, and, odd, ok fine
    assert one["n_tokens"] == words + 4 + 3 + 768 + 1 + 1 + 0
    assert got[2]["formatted"] == "<|turn|><|says|><|end|>" and got[2]["n_tokens"] == 0


def test_a_visitor_can_price_parts_its_own_way(spark):
    class Flat(C.PartVisitor):
        def image(self, part):
            return F.lit("<|image|>"), F.lit(100).cast("long")

    df = spark.createDataFrame([(1, 0, "user", [part("image", ref="a", width=9999, height=9999)])], TYPED)
    assert C.render_turns(df, visitor=Flat()).first()["n_tokens"] == 100


def test_awkward_rows(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "first"), (1, 3, "assistant", "b"), (1, 3, "assistant", "a"), (1, 3, "assistant", "a"),
        (None, 1, "assistant", "nobody's"), (None, None, None, None), (2, 0, "assistant", "word " * 60_000 + "<|end|>"), (3, 0, "user", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(1) for c in ("formatted", "loss", "seen", "head", "before", "attachments", "n_tokens")})
    got = {r["conv_id"]: r for r in C.read_back(C.render_turns(df)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    one = "\n\nuser\nfirst\nassistant\na\nassistant\na\nassistant\nb\n"
    assert (got[1]["n_turns"], got[1]["turns_sha256"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (5, sha(one), 3, sha("aab"))
    assert got[None]["n_turns"] == 2 and got[None]["loss_sha256"] == sha("nobody's")
    assert got[2]["loss_sha256"] == sha(rows[7][3]) and got[2]["loss_chars"] == len(rows[7][3])
    assert got[3]["loss_chars"] == 0 and got[3]["loss_sha256"] == sha("")
    whole = {r["conv_id"]: r["formatted"] for r in C.conversations(C.render_turns(df)).collect()}
    assert {k: len(v) for k, v in whole.items()} == {k: v["formatted_chars"] for k, v in got.items()}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.read_back(C.render_turns(df)).collect() == C.conversations(C.render_turns(df)).collect() == []


def test_query_matches_sql(spark):
    name = "op13_chat_format"
    assert compare(queries()[name](spark, SF01), duckdb_connection(SF01), oracle_sql()[name]) == []
