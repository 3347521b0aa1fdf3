"""Captures and dated list entries derived from the ``pages`` table, in two dialects.

The pages carry neither fetch times nor lists. A page's time comes from its id; hosts,
domains and first path segments are listed, removed and listed again on days taken from
a digest of their name. So both grow with the pages.
"""

SPARK = {"hex": "cast(conv(substr(md5({0}), 1, 6), 16, 10) as bigint)",
         "domain": "substring_index({0}, '.', -2)", "bigint": "bigint"}
DUCKDB = {"hex": "cast(('0x' || substr(md5({0}), 1, 6)) as bigint)",
          "domain": "array_to_string(list_slice(string_split({0}, '.'), -2, -1), '.')",
          "bigint": "bigint"}

START = 1_704_067_200  # 2024-01-01, seconds

#: (list, pattern, share one in n, shift of the day): one feed of entries each.
FEEDS = [("hosts", "host", 3, 0), ("domains", "domain", 5, 17), ("paths", "path", 4, 31),
         ("allow", "host", 7, 5)]


def captures_sql(pages: str) -> str:
    return (f"select page_id, url, cast({START} + (page_id * 7919 % 525600) * 60 as bigint)"
            f" as fetched_at from {pages}")


def feed_sql(names: str, words: dict[str, str]) -> str:
    """Entries from a table of (host, domain, path)."""
    parts = []
    for name, column, share, shift in FEEDS:
        number = words["hex"].format("pattern")
        parts.append(f"select '{name}' as list_name, pattern, {number} as v, {shift} as shift"
                     f" from (select distinct {column} as pattern from {names}) t"
                     f" where pattern <> '' and {number} % {share} = 0")
    listed = " union all ".join(parts)
    day = "(v % 200 + shift)"
    moves = [("add", day, ""), ("remove", f"({day} + 20 + v % 60)", "where list_name <> 'allow'"),
             ("add", f"({day} + 120)", "where v % 2 = 0 and list_name <> 'allow'")]
    return " union all ".join(
        f"select list_name, pattern, '{action}' as action,"
        f" cast({START} + {when} * 86400 as bigint) as listed_at from ({listed}) l {where}"
        for action, when, where in moves)
