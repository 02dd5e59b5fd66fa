"""Chat records of several layouts to one template, by fingerprint of their field paths."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the template: what may not occur inside a text unescaped.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_CONTROL = re.compile(r"<(?=\|im_(?:start|end)\|>|/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

# Declarative mappings. "turns": the list, and in each element the fields of role and text.
# "fields": roles and the top-level fields their texts are in, in order; those with ? may be missing, and texts of one role
# that follow each other are one turn, with an empty line between.
LAYOUTS = {
    "messages": {"turns": ("messages", "role", "content")},
    "shares": {"turns": ("conversations", "from", "value")},
    "prompt": {"fields": (("system", "system?"), ("user", "prompt"), ("assistant", "response"))},
    "instruction": {"fields": (("system", "system?"), ("user", "instruction"), ("user", "input?"), ("assistant", "output"))},
}
#: Fields a record or a turn of any layout may carry besides, whatever text they hold.
BESIDES = ("id", "source", "dataset", "lang", "model", "created", "metadata")
SCHEMA = "{id} {kind}, layout string, n_turns long, formatted string, loss_start array<long>, loss_length array<long>"


def field_paths(value, prefix: str = "", leaves: set[str] = frozenset()) -> set[str]:
    """Paths of all nested fields; elements of a list share ``[]``. What is inside a field among ``leaves`` is not looked at."""
    if prefix in leaves:
        return set()
    if isinstance(value, dict):
        found = set()
        for key, inner in value.items():
            path = f"{prefix}.{key}" if prefix else key
            found |= {path} | field_paths(inner, path, leaves)
        return found
    if isinstance(value, list):
        return {f"{prefix}[]"}.union(*(field_paths(inner, f"{prefix}[]", leaves) for inner in value))
    return set()


def _with_text(value) -> bool:
    """Whether a value holds any text."""
    if isinstance(value, dict):
        return any(_with_text(inner) for inner in value.values())
    return any(_with_text(inner) for inner in value) if isinstance(value, list) else isinstance(value, str) and value != ""


def counted(value, known: set[str], besides: tuple[str, ...], prefix: str = ""):
    """The value without the fields a layout does not have to know: those among ``besides``, and unknown ones without text."""
    if isinstance(value, dict):
        kept = {}
        for key, inner in value.items():
            path = f"{prefix}.{key}" if prefix else key
            if path in known or key not in besides and _with_text(inner):
                kept[key] = counted(inner, known, besides, path)
        return kept
    return [counted(inner, known, besides, f"{prefix}[]") for inner in value] if isinstance(value, list) else value


def fingerprint(paths: set[str]) -> str:
    """128-bit hash of the sorted paths."""
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def _registry(layouts: dict) -> tuple[dict[str, str], set[str], set[str]]:
    """Layout by fingerprint, for every choice of optional fields; all paths of layouts; those of them that are texts or roles."""
    names, known, leaves = {}, set(), set()
    for name, layout in layouts.items():
        if "turns" in layout:
            at, role, text = layout["turns"]
            whole = {at, f"{at}[]", f"{at}[].{role}", f"{at}[].{text}"}
            choices = [whole, {at, f"{at}[]"}]  # without turns
            leaves |= {f"{at}[].{role}", f"{at}[].{text}"}
        else:
            fields = [field for _, field in layout["fields"]]
            leaves |= {field.rstrip("?") for field in fields}
            choices = [{f for f in fields if not f.endswith("?")}]
            for field in fields:
                if field.endswith("?"):
                    choices += [choice | {field[:-1]} for choice in choices]
        for choice in choices:
            known |= choice
            if names.setdefault(fingerprint(choice), name) != name:
                raise ValueError(f"layouts {name} and {names[fingerprint(choice)]} have the same paths")
    return names, known, leaves


def plain(value) -> str:
    """Text as it is, null as the empty text, anything else as its JSON."""
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: dict) -> list[tuple[str, str]] | None:
    """Role and text of every turn, in order; None if something in the list of turns is no turn."""
    if "turns" in layout:
        at, role, text = layout["turns"]
        if not all(isinstance(turn, dict) for turn in record[at]):
            return None
        return [(plain(turn.get(role)), plain(turn.get(text))) for turn in record[at]]
    turns: list[tuple[str, str]] = []
    for role, field in layout["fields"]:
        if field.rstrip("?") not in record:
            continue
        text = plain(record[field.rstrip("?")])
        if turns and turns[-1][0] == role:
            text = "\n\n".join(part for part in (turns.pop()[1], text) if part)
        turns.append((role, text))
    return turns


def escape(text: str) -> str:
    """A backslash before every backslash, and after the first sign of every control string."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted text, and begin and length (code points) of the assistant texts in it."""
    out, at, begins, lengths = [], 0, [], []
    for role, text in turns:
        head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
        body = escape(text)
        if role == "assistant":
            begins.append(at + len(head))
            lengths.append(len(body))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), begins, lengths


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        head = re.match(r"((?:[^\\\n]|\\.)*)\n", part[len(OPEN) :], re.DOTALL)
        turns.append((unescape(head[1]), unescape(part[len(OPEN) + head.end() :])))
    return turns


def format_chats(records: DataFrame, id: str = "conv_id", record: str = "record", layouts: dict = LAYOUTS) -> DataFrame:
    """``id``, ``layout``, ``n_turns``, ``formatted``, ``loss_start``, ``loss_length`` for every JSON record.

    The paths of a record's fields are hashed; the hash selects the mapping that turns the record into roles and texts. No
    text is lost on the way: a field that no layout knows, and that holds text, makes a record unknown, unless it is among
    ``BESIDES``. Unknown fields without text are ignored. A turn is
    ``<|im_start|>role, newline, text, <|im_end|>, newline``; control strings of this and other common
    templates are escaped in texts and roles with a backslash and read back by :func:`parse`. The loss
    mask covers the assistant texts, as begin and length in code points of the formatted text.

    Null roles and texts are empty; values that are not text are their JSON. A null, empty, broken or unknown record, and one
    with something else than objects among its turns, is a reject: a null layout, no turns and an empty formatted text.
    Repeated records and null ids give a row each. An empty table gives an empty result; other columns are ignored.
    """
    names, known, leaves = _registry(layouts)
    kind = records.schema[id].dataType.simpleString()

    def one(source: str | None):
        try:
            value = json.loads(source or "")
        except ValueError:
            return None, 0, "", [], []
        name = turns = None
        if isinstance(value, dict):
            name = names.get(fingerprint(field_paths(counted(value, known, BESIDES), leaves=leaves)))
            turns = turns_of(value, layouts[name]) if name else None
        if turns is None:
            return None, 0, "", [], []
        return name, len(turns), *render(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = list(zip(*(one(source) for source in part.column(1).to_pylist())))
                types = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
                columns = [pa.array(values, kind) for values, kind in zip(made, types)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns], [id, "layout", "n_turns", "formatted", "loss_start", "loss_length"]
                )

    return records.select(id, F.col(record).cast("string")).mapInArrow(run, SCHEMA.format(id=f"`{id}`", kind=kind))


def digests(formatted: DataFrame, id: str = "conv_id") -> DataFrame:
    """What can be read back from :func:`format_chats`: turns, text under the loss mask, lengths.

    A row for every row, null and repeated ids too. A reject has no turns, no loss and the hash of the empty text. An empty
    table gives an empty result; other columns are ignored.
    """
    kind = formatted.schema[id].dataType.simpleString()

    def one(text: str, begins: list[int], lengths: list[int]):
        turns = parse(text)
        every = "".join(f"{role}\n{body}\n" for role, body in turns)
        loss = "".join(unescape(text[b : b + n]) for b, n in zip(begins, lengths))
        return (
            len(turns),
            hashlib.sha256(every.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
            len(text),
        )

    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
            made = list(zip(*(one(*row) for row in rows))) or [[]] * 5
            columns = [pa.array(values, kind) for values, kind in zip(made, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id, *names])

    schema = f"`{id}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select(id, "formatted", "loss_start", "loss_length").mapInArrow(run, schema)
