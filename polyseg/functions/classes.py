"""Script and white-space classes, as Java and RE2 patterns read them alike."""

from __future__ import annotations

from dataclasses import dataclass

# The core script, what else may stand in a run, and what may join two parts of it.
CJK = r"\x{4e00}-\x{9fff}"
RUN_EXTRA = r"\x{3000}-\x{303f}\x{ff00}-\x{ffef}"
SPACES = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
JOINERS = r",.:;()'\"\-"


@dataclass(frozen=True)
class ScriptClass:
    """A script to look for; the default is Chinese."""

    core: str = CJK
    extra: str = RUN_EXTRA
    joiners: str = JOINERS

    def run(self, spaces: str = SPACES) -> str:
        k = f"[{self.core}{self.extra}]"
        return f"{k}(?:[{self.core}{self.extra}{spaces}{self.joiners}]*{k})?"

    def has(self) -> str:
        return f"[{self.core}]"


CHINESE = ScriptClass()
