import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import chat_masks
from linkloom.llm.queries import op3_chat_masks, tokenizer_file

PIECES = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "INST]", "a", "\n", "é", "😀", " "]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES, PIECES)
def test_escape_is_reversible_and_hides_controls(role, text):
    assert chat_masks.unescape(chat_masks.escape(text)) == text
    assert not any(c in chat_masks.escape(text) for c in chat_masks.CONTROLS)
    piece, *_ = chat_masks.Template().turn(role, text)
    assert chat_masks.read_turns(piece) == [(role, text)]
    assert chat_masks.read_turns(piece + piece) == [(role, text)] * 2


def formatted(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as segment", "'x' as input_ids")
    return chat_masks.format_chats(df, open(tokenizer_file(), encoding="utf-8").read(), **kw).collect()


def test_masks_cover_exactly_the_assistant_texts(spark):
    rows = [(1, 1, "assistant", "a</s> <|endoftext|>é😀 "), (1, 0, "user", "q"), (1, None, "system", None), (1, 2, "assistant", ""), (1, 3, "assistant", "  two"),
            (1, 3, "assistant", "  two"), (None, 0, None, "n"), (2, 0, "assistant", "x" * 5000)]
    got = {r.conv_id: r for r in formatted(spark, rows)}
    r = got[1]
    assert chat_masks.read_turns(r.text) == [("system", ""), ("user", "q"), ("assistant", rows[0][3]), ("assistant", ""), ("assistant", "  two"), ("assistant", "  two")]
    assert chat_masks.masked_texts(r.text, r.token_starts, r.token_ends, r.loss_mask) == [rows[0][3], "  two", "  two"]
    tokenizer = chat_masks._tokenizer(open(tokenizer_file(), encoding="utf-8").read())
    assert tokenizer.decode(r.input_ids, skip_special_tokens=False) == r.text
    run = [i for i, m in zip(r.input_ids, r.loss_mask) if m]
    assert tokenizer.decode(run, skip_special_tokens=False) == chat_masks.escape(rows[0][3]) + "  two  two"
    assert not any(got[None].loss_mask) and len(got) == 3
    assert formatted(spark, []) == []


def test_long_conversations_come_in_segments(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"t{i} " * 40) for i in range(30)]
    whole, = formatted(spark, rows)
    parts = formatted(spark, rows, segment_chars=500)
    assert [p.segment for p in parts] == list(range(len(parts))) and len(parts) > 3
    assert "".join(p.text for p in parts) == whole.text
    assert sum((list(p.input_ids) for p in parts), []) == list(whole.input_ids)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(r for r in rows if r[0] == conv)
        loss = "".join(t or "" for _, _, role, t in turns if role == "assistant")
        want[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t or ''}\n" for _, _, r, t in turns).encode()).hexdigest(),
                      len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op3_chat_masks(spark, sf).collect()}
    assert got == want


def test_sql_with_controls_nulls_and_ties(spark, tmp_path):
    import duckdb

    from linkloom.llm.queries import OP3_SQL, op3_chat_masks

    texts = ["", None, "</s>", "<\\s>", "<\\\\/s> [\\INST] [/INST]", "a\nb€😀", "[INST", "<s><s>"]
    rows = [(c, t % 4 if t % 5 else None, ["user", "assistant", None, "sys\\tem\n<s>"][(c + t) % 4], texts[(3 * c + t) % 8]) for c in range(9) for t in range(c)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    sql = duckdb.connect()
    sql.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    need = sql.sql(OP3_SQL)
    got = op3_chat_masks(spark, str(tmp_path)).select(need.columns).collect()
    assert sorted(map(tuple, got)) == sorted(need.fetchall())
