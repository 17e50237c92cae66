"""Reading answers of text models: fenced, loose or cut-off JSON."""

from __future__ import annotations

import json
import re

_FENCE = re.compile(r"^\s*```[a-zA-Z]*\s*\n?|\n?\s*```\s*$")


def unfenced(text: str) -> str:
    return _FENCE.sub("", text or "").strip()


def loose_json(text: str | None):
    """The JSON value in an answer, also between other words; None if there is none."""
    s = unfenced(text or "")
    for a, z in (("{", "}"), ("[", "]")):
        i, j = s.find(a), s.rfind(z)
        for part in (s, s[i : j + 1] if 0 <= i < j else ""):
            try:
                return json.loads(part)
            except ValueError:
                pass
    return None


def salvage_array(text: str | None, key: str | None = None) -> list:
    """The whole objects of a JSON array that may be cut off anywhere; elements that don't parse are left out.

    With a key, the array is the value of that key. Text without such an array gives an empty list.
    """
    s = unfenced(text or "")
    if key is not None:
        m = re.search(r'"' + re.escape(key) + r'"\s*:\s*\[', s)
        if not m:
            return []
        at = m.end()
    else:
        at = s.find("[") + 1
        if not at:
            return []
    decode, out = json.JSONDecoder(), []
    while at < len(s):
        if s[at] == "]":
            break
        if s[at] != "{":
            at += 1
            continue
        try:
            value, at = decode.raw_decode(s, at)
            out.append(value)
        except ValueError:
            end = _object_end(s, at)
            if end is None:
                break
            at = end
    return out


def _object_end(s: str, at: int) -> int | None:
    """The place after the braces that open at `at`, or None if they never close."""
    depth, quoted = 0, False
    i = at
    while i < len(s):
        c = s[i]
        if quoted:
            if c == "\\":
                i += 1
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = True
        elif c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
            if not depth:
                return i + 1
        i += 1
    return None
