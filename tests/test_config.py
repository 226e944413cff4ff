"""Settings, and the independence of the optional subpackage."""

import os
import re
from pathlib import Path

import pytest

from pagelens import config as C

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize(("most", "least"), [(262144, 65536), (802816, 200704), (131072, 32768)])
def test_pixel_budget(most, least):
    assert C.pixel_budget(most) == (most, least)


def test_pixel_fallbacks():
    assert C.pixel_budget(size={"longest_edge": 400, "shortest_edge": "x"}) == (400, 100)
    assert C.pixel_budget(own_max=0) == (262144, 65536)
    assert C.pixel_budget(own_max="80", own_min=7) == (80, 7)


def test_resolve_order():
    config = {"a": {"b": 3}}
    assert C.resolve(1, {"x": 2}, config, "x", ("a", "b")) == 1
    assert C.resolve(None, {"x": 2}, config, "x", ("a", "b")) == 2
    assert C.resolve(None, {}, config, "x", ("a", "b")) == 3
    assert C.resolve(None, {}, {}, "x", ("a", "b"), 4) == 4


def test_env(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# c\nexport A_X = 'one'\nB_X=two=2\nnothing\n=bad\n")
    monkeypatch.setenv("B_X", "kept")
    monkeypatch.delenv("A_X", raising=False)
    assert C.load_env(str(tmp_path / ".env")) == {"A_X": "one", "B_X": "two=2"}
    assert os.environ["A_X"] == "one" and os.environ["B_X"] == "kept"
    monkeypatch.delenv("A_X")


def test_repo(monkeypatch):
    for v in ("HF_NAMESPACE", "A_ID"):
        monkeypatch.delenv(v, raising=False)
    find = lambda own=None, config={}: C.resolve_repo(own, ["A_ID"], "{namespace}/pages", config, ["repo"], "none")  # noqa: B006, E731
    assert (find("x"), find(), find(config={"repo": "c"})) == ("x", "none", "c")
    monkeypatch.setenv("HF_NAMESPACE", "me")
    assert find(config={"repo": "c"}) == "me/pages"
    monkeypatch.setenv("A_ID", "env")
    assert find() == "env"


def test_checkpoint(tmp_path):
    with pytest.raises(FileNotFoundError):
        C.checkpoint_in(str(tmp_path))
    (tmp_path / "weights").mkdir()
    (tmp_path / "weights/epoch.pt").touch()
    assert C.checkpoint_in(str(tmp_path)).endswith("epoch.pt")
    (tmp_path / "last.pt").touch()
    assert C.checkpoint_in(str(tmp_path)).endswith("last.pt")


def test_nothing_needs_the_llm_subpackage():
    for p in (ROOT / "pagelens").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT / "pagelens").parts:
            assert not re.search(r"pagelens\.llm|from \.llm", p.read_text()), p
