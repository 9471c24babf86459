"""JSON that is nearly right: repair of files, and arrays out of a model's answers."""

from __future__ import annotations

import json
import re
from typing import Any

# Keys under which an answer may wrap its array, and full-width signs that stand for JSON's own.
WRAPPERS = ("result", "results", "data", "items", "sentences", "output")
FULL_WIDTH = str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'", "＂": '"', "＇": "'", "，": ",", "：": ":", "［": "[", "］": "]", "｛": "{", "｝": "}"})
# Fixed value: most repairs of one file.
REPAIRS = 40

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"')


class _Scanner:
    """Reads JSON and notes where one comma lacks or is too much; anything else is beyond repair."""

    def __init__(self, text: str, most: int, kinds: tuple[str, ...] = ("missing_comma", "trailing_comma")) -> None:
        self.text, self.most, self.kinds, self.edits = text, most, kinds, []

    def space(self, i: int) -> int:
        while i < len(self.text) and self.text[i] in " \t\r\n":
            i += 1
        return i

    def edit(self, at: int, kind: str) -> None:
        if kind not in self.kinds or len(self.edits) == self.most:
            raise ValueError("too many repairs")
        self.edits.append((at, kind))

    def run(self) -> tuple[str, list[str]]:
        end = self.space(self.value(self.space(0)))
        if end != len(self.text):
            raise ValueError("more after the end")
        out, last = [], 0
        for at, kind in sorted(self.edits):
            out += [self.text[last:at], "," if kind == "missing_comma" else ""]
            last = at + (kind == "trailing_comma")
        return "".join([*out, self.text[last:]]), [k for _, k in self.edits]

    def value(self, i: int) -> int:
        # containers are kept on a stack of their own, so depth is no limit
        stack: list[str] = []
        while True:
            c = self.text[i : i + 1]
            if c in ("{", "["):
                stack.append(c)
                i = self.space(i + 1)
                if self.text[i : i + 1] == ("}" if c == "{" else "]"):
                    stack.pop()
                    i += 1
                else:
                    i = self.key(i) if c == "{" else i
                    continue
            else:
                i = self.scalar(i)
            while stack:  # behind a value: its container goes on or ends
                after, i = i, self.space(i)
                close = "}" if stack[-1] == "{" else "]"
                c = self.text[i : i + 1]
                if c == close:
                    stack.pop()
                    i += 1
                    continue
                if c == ",":
                    nxt = self.space(i + 1)
                    if self.text[nxt : nxt + 1] == close:
                        self.edit(i, "trailing_comma")
                        i = nxt
                        continue
                    i = nxt
                elif c in ('"', "{", "[") or re.match(r"[-\dtfn]", c or "?"):
                    self.edit(after, "missing_comma")
                else:
                    raise ValueError("not repairable")
                if stack[-1] == "{":
                    i = self.key(i)
                break
            if not stack:
                return i

    def key(self, i: int) -> int:
        if not (m := _STRING.match(self.text, i)):
            raise ValueError("no key")
        i = self.space(m.end())
        if self.text[i : i + 1] != ":":
            raise ValueError("no colon")
        return self.space(i + 1)

    def scalar(self, i: int) -> int:
        if m := _STRING.match(self.text, i) or re.compile(r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null").match(self.text, i):
            return m.end()
        raise ValueError("no value")


def repair(text: str, most: int = REPAIRS) -> tuple[Any, list[str]]:
    """(value or None, repairs made): only commas that lack or trail are put right."""
    try:
        return json.loads(text), []
    except ValueError:
        pass
    try:
        fixed, edits = _Scanner(text, most).run()
        return json.loads(fixed), edits
    except (ValueError, RecursionError):
        return None, ["not_repairable"]


def _unfenced(text: str) -> str:
    """Without a code fence around it, with or without the name of the format."""
    body = text.strip()
    if body.startswith("```"):
        body = body[3:]
        body = body[4:] if body[:4].lower() == "json" else body
    return body.removesuffix("```").strip()


def _elements(value: Any) -> list | None:
    """The array that an answer means: itself, under a wrapping key, or one bare item."""
    if isinstance(value, dict):
        wrapped = [value[k] for k in WRAPPERS if isinstance(value.get(k), list)]
        return wrapped[0] if wrapped else [value] if "sent_id" in value else None
    return value if isinstance(value, list) else None


def _loaded(text: str, lenient: bool) -> Any:
    try:
        return json.loads(_Scanner(text, len(text), ("trailing_comma",)).run()[0] if lenient else text)
    except (ValueError, RecursionError):
        return None


def answer_array(text: str | None) -> tuple[list, bool]:
    """(elements, whether the answer could be read): an empty array that was meant is not a failure.

    The answer as a whole comes first, then what stands between its first and
    last bracket; both as they are, then with full-width signs as JSON's own and
    trailing commas left out.
    """
    for lenient in (False, True):
        body = _unfenced((text or "").translate(FULL_WIDTH) if lenient else text or "")
        first, last = body.find("["), body.rfind("]")
        for part in [body, body[first : last + 1]] if 0 <= first < last else [body]:
            found = _elements(_loaded(part, lenient)) if part else None
            if found is not None:
                return found, True
    return [], False
