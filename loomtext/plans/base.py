"""Registry of queries: a function of (spark, sf_dir) and, where SQL can express it, its DuckDB twin."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


#: Sentences and tokens in DuckDB, as functions/text.py makes them.
SQL_SENTENCES = r"""sent AS (SELECT doc_id, source, lang, unnest(sents) AS sentence, generate_subscripts(sents, 1) - 1 AS sent_idx FROM
 (SELECT doc_id, source, lang, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS sents FROM documents))"""


def sql_lower(column: str) -> str:
    return f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def sql_tokens(column: str) -> str:
    return f"list_filter(regexp_split_to_array({sql_lower(column)}, '[^a-z]+'), lambda x: x <> '')"


def sql_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"
