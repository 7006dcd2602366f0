"""Paths and plain models that several test modules share."""

from __future__ import annotations

import contextlib
import io
import re

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


def java_space_split(s: str) -> list[str]:
    """Plain model of Java's ``s.split(" ")``: no match returns ``[s]``;
    otherwise split and drop trailing empty strings."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def text_file_lines(s: str) -> list[str]:
    """Plain model of a text line reader: CRLF, CR or LF ends a line and a
    final terminator adds no empty line."""
    if s == "":
        return []
    out = re.split("\r\n|\r|\n", s)
    if out[-1] == "":
        out.pop()
    return out


def explain_text(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
