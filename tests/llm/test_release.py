"""Workers outlive stages: tasks that need nothing kept drop it, and all give back their memory."""

from rollspan.llm import frames, kneser_ney, packing, simhash, toxicity


def test_toxicity_tasks_drop_what_others_keep():
    for task in (lambda: toxicity._features(iter([])), lambda: toxicity._sample_hits(iter([]), []), lambda: toxicity._scores(iter([]), {}),
                 lambda: toxicity._kept(iter([]), {}, 0, 0.7)):
        frames.held("vocabulary", list)
        assert not list(task()) and not frames._HELD


def test_tasks_give_back_their_memory_when_they_end(monkeypatch):
    calls = []
    monkeypatch.setattr(frames, "give_back", lambda: calls.append("back"))

    def batches():
        yield from ()
        calls.append("read")
    for task in (lambda: toxicity._kept(batches(), {}, 0, 0.7), lambda: kneser_ney._block_counts(batches(), 64), lambda: kneser_ney._answered(batches(), None),
                 lambda: kneser_ney._scored(batches()), lambda: simhash._sketches(batches(), 5), lambda: packing._merge(batches(), 1024, 64)):
        calls.clear()
        list(task())
        assert calls[-2:] == ["read", "back"]
