"""Dialogues whose turn numbers repeat are cut into bounded parts, in order."""

from tidemark.llm import chat_views

SHAPE = "conv_id long, turn long, role string, text string"


def test_a_hot_segment_is_cut_in_order(spark):
    hot = [(None, n % 8, "ann" if n % 3 else "bob", f"said {n:05d}") for n in range(3000)]
    none = [(5, None, "ann", "same") for _ in range(2500)]
    few = [(6, None, "bob", f"late {n}") for n in range(9)] + [(6, 0, "ann", "first")]
    docs = spark.createDataFrame(hot + none + few, SHAPE).repartition(5)
    got = chat_views.views(docs).collect()
    assert max(r.n_turns for r in got) <= 1024

    def whole(conv, segment, participant):
        parts = sorted((r.part, r.text, r.n_turns) for r in got if (r.conv_id, r.segment, r.participant) == (conv, segment, participant))
        assert [p for p, *_ in parts] == list(range(len(parts)))
        assert all(n == 1024 for *_, n in parts[:-1])
        return "".join(t for _, t, _ in parts)

    def plain(rows, participant):
        head = lambda name: "assistant" if name == participant else f"user name={name}"
        said = sorted((turn or 0, name, text) for _, turn, name, text in rows)
        return "".join(f"<|im_start|>{head(name)}\n{text}<|im_end|>\n" for _, name, text in said)

    assert whole(None, 0, "ann") == plain(hot, "ann") and whole(None, 0, "bob") == plain(hot, "bob")
    assert whole(5, None, "ann") == plain(none, "ann")
    assert whole(6, None, "bob") == plain(few[:9], "bob") and whole(6, 0, "ann") == plain(few[9:], "ann")
