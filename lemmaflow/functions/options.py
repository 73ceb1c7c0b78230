"""Options of a conversion, checked on the driver before a plan is built."""

from __future__ import annotations

from collections.abc import Mapping

# ---- fixed values
CHOICES = {"prompt_profile": ("auto", "textbook", "paper", "chinese_math"), "structure_mode": ("auto", "llm", "hard"), "audit_mode": ("auto", "llm", "off")}
MODEL_BACKENDS = ("openai", "azure", "mock")


def checked(options: Mapping[str, object]) -> dict[str, str]:
    """The known options, ``auto`` where none is given; a value that isn't a choice is an error."""
    out = {name: str(options.get(name, "auto")) for name in CHOICES}
    for name, value in out.items():
        if value not in CHOICES[name]:
            raise ValueError(f"Unsupported {name}.")
    return out


def _mode(mode: str | None) -> str:
    return (mode or "auto").strip().lower()


def audits(mode: str | None, backend: str) -> bool:
    """Whether sections are audited: by a model, unless switched off."""
    return _mode(mode) in ("auto", "llm") and backend in MODEL_BACKENDS


def planner(mode: str | None, backend: str) -> str:
    """``never``, ``always`` or ``asked``: where it is asked, ``structure.planner_needed`` tells for each document."""
    if backend not in MODEL_BACKENDS:
        return "never"
    return {"llm": "always", "auto": "asked"}.get(_mode(mode), "never")
