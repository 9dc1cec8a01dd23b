from sentilake.llm import common


def test_freed_memory_is_given_back_when_another_operator_starts(monkeypatch):
    monkeypatch.setattr(common, "_HELD", {})
    done = []
    monkeypatch.setattr(common, "give_back", lambda: done.append("back"))
    common.hold("a", lambda: done.append("a"))
    common.hold("a", lambda: done.append("a"))
    assert done == []
    common.hold("b", lambda: done.append("b"))
    assert done == ["a", "back"] and list(common._HELD) == ["b"]


def test_memory_can_be_given_back():
    common.give_back()
