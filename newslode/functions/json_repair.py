"""Reading model output: fences off, objects found by their braces, text repaired, fields filled."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import text

SUMMARY = {"theme": "", "stance": "Neutral", "synopsis": "", "key_points": [], "risk_flags": [], "watch_items": []}
STANCES = ("Bullish", "Bearish", "Neutral", "Mixed", "Unknown")


def objects(raw: str, most: int = 10) -> list[str]:
    """Texts of the balanced objects that begin at the first braces; strings and escapes are respected."""
    out = []
    for start in [m.start() for m in re.finditer(r"\{", raw)][:most]:
        depth, quoted, escaped = 0, False, False
        for i, c in enumerate(raw[start:], start):
            if quoted:
                escaped, quoted = (c == "\\" and not escaped), not (c == '"' and not escaped)
            elif c == '"':
                quoted = True
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if not depth:
                    out.append(raw[start : i + 1])
                    break
    return out


def repaired(raw: str) -> str:
    """Straight quotes, null for missing values, no commas before a close, no control characters."""
    out = raw.translate(str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'"}))
    out = re.sub(r":\s*(?=[,}])", ": null", out)
    out = re.sub(r",\s*(?=[}\]])", "", out)
    return re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", out)


def summary_of(raw: str | None) -> dict:
    """The first object, as it is or repaired, with every field filled and of its type."""
    raw = re.sub(r"^```[\w-]*\s*|\s*```$", "", (raw or "").strip())
    found: dict = {}
    for t in (raw, *objects(raw), *map(repaired, (raw, *objects(raw)))):
        try:
            x = json.loads(t)
        except ValueError:
            continue
        if isinstance(x, dict):
            found = x
            break
    out: dict = {}
    for k, default in SUMMARY.items():
        v = found.get(k)
        if isinstance(default, list):
            v = [v] if isinstance(v, str) else v
            out[k] = [" ".join(str(p).split()) for p in v if p][:6] if isinstance(v, list) else []
        else:
            out[k] = " ".join(v.split()) if isinstance(v, str) else default
    out["stance"] = out["stance"].title() if out["stance"].title() in STANCES else "Neutral"
    return out


@F.pandas_udf(T.StructType([T.StructField(k, T.ArrayType(T.StringType()) if isinstance(v, list) else T.StringType()) for k, v in SUMMARY.items()]))
def parse_summary(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([summary_of(x) for x in raw], columns=list(SUMMARY))


def substantive(summary: Column) -> Column:
    """Theme of three characters, synopsis of forty, one point at least."""
    return (F.length(text(summary["theme"])) >= 3) & (F.length(text(summary["synopsis"])) >= 40) & (F.size(F.coalesce(summary["key_points"], F.array().cast("array<string>"))) >= 1)


def has_required(payload: Column, keys) -> Column:
    """Every key stands in the JSON text with a value."""
    out = F.lit(True)
    for k in keys:
        out = out & F.get_json_object(payload, f"$.{k}").isNotNull()
    return out


def message_content(body: Column) -> Column:
    """The text of a chat response: of the message, else of the choice itself."""
    return F.coalesce(F.get_json_object(body, "$.choices[0].message.content"), F.get_json_object(body, "$.choices[0].text"), F.get_json_object(body, "$.response"))
