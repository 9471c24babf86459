"""Sinks: Parquet as the canonical table, a sheet for each file, a package, a raw dump, a report."""

from __future__ import annotations

import io
import json
import os
import tempfile
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.text import TYPES
from termloom.operators.delivery import COLUMNS, ORDER

SHEET = "terms"
_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>'
_RELS = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{kind}" Target="{target}"/></Relationships>'
_BOOK = f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{SHEET}" sheetId="1" r:id="rId1"/></sheets></workbook>'


def xlsx_bytes(header: list[str], rows: list[list]) -> bytes:
    """A workbook of one sheet with inline strings."""

    def cell(v: object) -> str:
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v}</v></c>"
        text = "".join(c for c in str("" if v is None else v) if c in "\t\n\r" or ord(c) >= 32)
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'

    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [header, *rows])
    sheet = f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in (("[Content_Types].xml", _TYPES), ("_rels/.rels", _RELS.format(kind="officeDocument", target="xl/workbook.xml")), ("xl/workbook.xml", _BOOK), ("xl/_rels/workbook.xml.rels", _RELS.format(kind="worksheet", target="worksheets/sheet1.xml")), ("xl/worksheets/sheet1.xml", sheet)):
            z.writestr(name, text)
    return out.getvalue()


def read_xlsx(content: bytes) -> tuple[list[str], list[list]]:
    """Header and rows of a sheet this module wrote."""
    import xml.etree.ElementTree as ET

    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ET.fromstring(z.read("xl/worksheets/sheet1.xml"))
    rows = [[(c.findtext("m:is/m:t", "", ns) if c.get("t") == "inlineStr" else int(c.findtext("m:v", "0", ns))) for c in r.findall("m:c", ns)] for r in root.iterfind("m:sheetData/m:row", ns)]
    return rows[0], rows[1:]


def replace_file(path: str, content: bytes) -> None:
    """Write beside and rename, so a reader never sees half a file."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    with os.fdopen(fd, "wb") as f:
        f.write(content)
    os.replace(temp, path)


def write_tables(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The delivered table as Parquet, a folder for each output name; an existing one is an error unless told."""
    rows.write.mode(mode).partitionBy("out_name").parquet(path)


def sheets(rows: DataFrame) -> DataFrame:
    """out_name, n_rows, content: a workbook for each output name, in delivery order; names without rows have none.

    A file's rows are what a person opens, so a group is bounded by that.
    """

    def make(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([c for c in ORDER if c in part.columns])
        body = part[COLUMNS].astype(object).where(part[COLUMNS].notna(), "").values.tolist()
        return pd.DataFrame({"out_name": [part["out_name"].iloc[0]], "n_rows": [len(part)], "content": [xlsx_bytes(COLUMNS, body)]})

    return rows.groupBy("out_name").applyInPandas(make, "out_name string, n_rows long, content binary")


def package(books: DataFrame, path: str, extra: dict[str, bytes] | None = None) -> int:
    """A flat zip of all workbooks and further files; none if there is no workbook. Books come one at a time."""
    count, out = 0, io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for r in books.orderBy("out_name").toLocalIterator():
            z.writestr(r["out_name"].rsplit("/", 1)[-1], r["content"])
            count += 1
        for name, content in (extra or {}).items():
            z.writestr(name, content)
    if count:
        replace_file(path, out.getvalue())
    return count


FIELDS = {
    "sent_id": "number of the sentence in its file",
    "src_text": "the source sentence as it stands",
    "tgt_text": "the target sentence as it stands",
    "term_src": "the term, a verbatim slice of src_text",
    "term_tgt": "the term, a verbatim slice of tgt_text",
    "types": "types of the term, separated by commas: " + ", ".join(TYPES),
    "note": "always empty",
    "term_src_dict": "dictionary form of term_src, or the slice itself",
    "term_tgt_dict": "dictionary form of term_tgt, or the slice itself",
}


def field_description() -> bytes:
    """The delivered columns in order, for the package."""
    return "\n".join(f"{i}. {c}: {FIELDS[c]}" for i, c in enumerate(COLUMNS, 1)).encode()


def read_me(lang: str, files: int, rows: int) -> bytes:
    return f"Terms of the {lang} corpus: {rows} rows in {files} files, one sheet '{SHEET}' in each.\nColumns are described in FIELDS.txt.\n".encode()


def raw_dump(rows: DataFrame, path: str) -> None:
    """All rows as JSON with spans and delivered forms."""
    rows.write.mode("overwrite").json(path)


def incomplete_report(incomplete: DataFrame, most: int = 500) -> str:
    """Text with every dead or skipped batch, a remainder told when there are more lines; the table itself has no cap."""
    lines = [f"{r['file']} batch {r['batch_idx']} positions {r['first_pos']}-{r['last_pos']}: {r['why']}" for r in incomplete.orderBy("file", "batch_idx").limit(most).collect()]
    more = incomplete.count() - len(lines)
    return "\n".join([*lines, f"and {more} more"] if more > 0 else lines)


def incomplete_table(batches: DataFrame, outcomes: DataFrame, skipped: DataFrame) -> DataFrame:
    """file, batch_idx, first_pos, last_pos, why for every batch without a usable answer."""
    dead = outcomes.where("not ok or parse_failed").select("file", "batch_idx", F.when(~F.col("ok"), "call_failed").otherwise("unreadable").alias("why"))
    lost = dead.unionByName(skipped.select("file", "batch_idx", F.lit("skipped").alias("why")))
    return batches.join(lost, ["file", "batch_idx"]).select("file", "batch_idx", F.get("pairs", F.lit(0))["pos"].alias("first_pos"), F.element_at("pairs", -1)["pos"].alias("last_pos"), "why")


def save_report(metrics: DataFrame, gates: DataFrame, path: str, calls: dict | None = None) -> None:
    """Metrics and gates of a run, and what its calls came to."""
    one = metrics.first()
    text = {"metrics": one.asDict() if one else {}, "gates": [r.asDict() for r in gates.collect()], **({"calls": calls} if calls else {})}
    replace_file(path, json.dumps(text, ensure_ascii=False, indent=2, default=str).encode())


def key_of(env: str, files: Iterator[str] = ()) -> str:
    """A provider's key from the environment or a file; it never appears in plans or logs, only `key_mark` may."""
    if value := os.environ.get(env, "").strip():
        return value
    for path in files:
        if os.path.exists(path):
            with open(path, encoding="utf-8-sig") as f:
                if value := f.read().strip():
                    return value
    raise ValueError(f"no key in {env} or the key files")


def key_mark(key: str) -> str:
    import hashlib

    return hashlib.sha256(key.encode()).hexdigest()[:8]


def prompt_parts(text: str, divider: str = "\n===USER===\n") -> tuple[str, str]:
    """(system, user): a text without the divider is all system; the user's part must hold {pairs}."""
    system, found, user = text.partition(divider)
    user = user if found else "{pairs}"
    if "{pairs}" not in user:
        raise ValueError("the user's part must hold {pairs}")
    return system.strip(), user.strip()
