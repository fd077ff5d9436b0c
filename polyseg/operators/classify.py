"""Which paths are translatable, and their language."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Text that is meant to stay as it is.
EXCLUDED = (
    "*/locales/*", "*/messages/*", "*/langs/*", "*/i18n/*", "*/[[]locale[]]/*",
    "*locale*/messages.*", "*locale*/langs.*", "*locale*/messages/*", "*.arb",
    "*zh-CN*", "*zh_CN*", "*.zh.*",
    "*README*.ja*", "*README*_ja*", "*README*_JA*", "*README*.zh*", "*README*_zh*", "*README*_ZH*",
    "*README.en*", "*README_en*", "*README_EN*",
    "*/.git/*", "*/node_modules/*", "*/vendor/*", "*/dist/*", "*/.next/*", "*/build/*", "*/.dart_tool/*",
)
GENERATED = ("*/gen/*", "*/generated/*", "*.pb.go", "*.pb.ts", "*.pb.dart", "*_pb2.py", "*.g.dart", "*.freezed.dart", "*/migrate/schema.go", "*/wire_gen.go", "*/ent/*")
WRITTEN_BY_HAND = ("*/ent/schema/*",)
LANGUAGES = {
    "go": "go", "proto": "proto", "ts": "typescript", "tsx": "tsx", "vue": "vue", "dart": "dart", "md": "markdown", "cs": "csharp", "sh": "bash",
    "yaml": "yaml", "yml": "yaml", "sql": "sql", "scss": "scss", "css": "css", "less": "css", "ps1": "powershell", "json": "json", "html": "html",
}


def glob_pattern(globs) -> str:
    """One pattern for all globs, in which * also crosses slashes."""
    one = lambda g: "".join(".*" if c == "*" else re.escape(c) for c in g.replace("[[]", "\0").replace("[]]", "\1")).replace("\0", r"\[").replace("\1", r"\]")
    return "^(?s:" + "|".join(one(g) for g in globs) + ")$"


def _probe(path: Column) -> Column:
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p))


def suffix(path: Column) -> Column:
    return F.regexp_extract(_probe(path), r"[^/]\.([^./]+)$", 1)


def language(path: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in LANGUAGES.items() for x in kv))[suffix(path)]


def is_translatable(path: Column) -> Column:
    p = _probe(path)
    return (
        F.when(~suffix(path).isin(*LANGUAGES), False)
        .when(p.rlike(glob_pattern(EXCLUDED)), False)
        .when(p.rlike(glob_pattern(WRITTEN_BY_HAND)), True)
        .when(p.rlike(glob_pattern(GENERATED)), False)
        .otherwise(True)
    )
