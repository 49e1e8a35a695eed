"""Added spans don't depend on how many windows are run at once."""
import numpy as np

from barlake.llm import pii


class Edges:
    """Labels a window's first three places as an ip, and nothing else."""

    def decode(self, windows):
        out = np.zeros(windows.shape, np.int64)
        label = 2 * pii.KINDS.index("ip") + 1
        out[:, 0], out[:, 1:3] = label, label + 1
        return out


def test_runs_change_no_span(monkeypatch):
    text = "1 a " * 200
    whole = pii.tag_texts(Edges(), [text])
    assert whole == [[("ip", 0, 3)]]  # later windows' beginnings stand more centrally in the window before
    for size in (1, 2, 3):
        monkeypatch.setattr(pii, "RUN_AT_ONCE", size)
        assert pii.tag_texts(Edges(), [text]) == whole
