"""The queries of this folder, and their SQL where SQL can say the same on whole tables.

Without SQL are those that read brackets, tokenizers, floating hash projections, edits of passages or language models.
"""

from __future__ import annotations

from corpusloom.llm import canonical, crosssplit, groupsplit, language, leaks, matches, neardup, packing, representative
from corpusloom.plans.registry import _path


def queries() -> dict:
    return {
        "p1_found": canonical.p1_found,
        "p1_groups": canonical.p1_groups,
        "p2_found": matches.p2_found,
        "p2_groups": matches.p2_groups,
        "p3_found": crosssplit.p3_found,
        "p3_report": crosssplit.p3_report,
        "p4_found": neardup.p4_found,
        "p4_groups": neardup.p4_groups,
        "p5_found": representative.p5_found,
        "p5_built": representative.p5_built,
        "p6_found": groupsplit.p6_found,
        "p6_splits": groupsplit.p6_splits,
        "p7_containers": packing.p7_containers,
        "p7_fill": packing.p7_fill,
        "p8_found": leaks.p8_found,
        "p8_report": leaks.p8_report,
        "p9_found": language.p9_found,
        "p9_segments": language.p9_segments,
        "p9_documents": language.p9_documents,
    }


def _id(c: str) -> str:
    sign = r"""[\s\x0B\p{Z}\p{Cf}"''`]"""
    return f"nullif(regexp_replace(lower({c}), '^{sign}+|{sign}+$', '', 'g'), '')"


_MATCHES = f"""named AS (SELECT DISTINCT {_id('id')} AS x, {_id('canonical')} AS y FROM structural_removed),
  link AS (SELECT x, y FROM named WHERE x <> y UNION SELECT y, x FROM named WHERE x <> y),
  reach AS (SELECT x AS a, x AS b FROM link UNION SELECT r.a, l.y FROM reach r JOIN link l ON r.b = l.x),
  comp AS (SELECT a, min(b) AS c FROM reach GROUP BY 1),
  grouped AS (SELECT id, c FROM (SELECT DISTINCT id, {_id('id')} AS a FROM records) JOIN comp USING (a)),
  named_groups AS (SELECT min(id) OVER (PARTITION BY c) AS group_id, id FROM grouped)"""


def _runs(rows: str, key: str, text: str, k: int) -> str:
    """``w`` (key, words) and ``sh`` (key, run): the distinct runs of k words."""
    words = f"list_transform(regexp_extract_all({text}, '[A-Za-z0-9_]+'), lambda x: lower(x))"
    return f"""w AS (SELECT {key}, {words} AS w FROM {rows}),
  sh AS (SELECT DISTINCT {key}, array_to_string(w[i : i + {k - 1}], ' ') AS s FROM (SELECT {key}, w, unnest(generate_series(1, len(w) - {k - 1})) AS i FROM w WHERE len(w) >= {k})),
  n AS (SELECT {key}, count(*) AS n FROM sh GROUP BY 1)"""


_SAID = "list_transform(list_filter(messages, lambda m: lower(trim(m.role)) = 'assistant' AND m.content IS NOT NULL), lambda m: m.content)"
_SPLIT = r"lower(regexp_replace(split, '[\s\p{Z}]+', '', 'g'))"
_CROSS = f"""chat AS (SELECT id, CASE {_SPLIT} WHEN 'validation' THEN 'dev' WHEN 'train' THEN 'train' WHEN 'dev' THEN 'dev' WHEN 'test' THEN 'test' END AS split,
    meta.source_path AS source_path, CASE WHEN len({_SAID}) > 0 THEN array_to_string({_SAID}, chr(10)) END AS text FROM chat_examples),
  one AS (SELECT *, row_number() OVER () AS r FROM (SELECT DISTINCT id, split <> 'train' AS held, text FROM chat WHERE split IS NOT NULL AND text IS NOT NULL)),
  {_runs('one', 'r', 'text', 3)}, side AS (SELECT one.id, held, n.* FROM one JOIN n USING (r)),
  inter AS (SELECT a.r AS e, b.r AS t, count(*) AS i FROM sh a JOIN one x ON x.r = a.r AND x.held JOIN sh b ON a.s = b.s JOIN one y ON y.r = b.r AND NOT y.held GROUP BY 1, 2),
  near AS (SELECT x.id AS e, y.id AS t, i / (x.n + y.n - i)::DOUBLE AS jaccard FROM inter JOIN side x ON x.r = e JOIN side y ON y.r = t WHERE i / (x.n + y.n - i)::DOUBLE >= 0.7 - 1e-9)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": f"WITH RECURSIVE {_MATCHES} SELECT DISTINCT group_id, id FROM named_groups WHERE group_id <> id",
        "p2_groups": f"WITH RECURSIVE {_MATCHES} SELECT group_id, id FROM named_groups",
        "p3_found": f"WITH {_CROSS} SELECT DISTINCT least(e, t) AS id_a, greatest(e, t) AS id_b FROM near WHERE e <> t",
        "p3_report": f"""WITH {_CROSS}, best AS (SELECT e AS id, max(jaccard) AS best FROM near GROUP BY 1),
  held AS (SELECT DISTINCT id, split, source_path FROM chat WHERE split IN ('dev', 'test'))
  SELECT split, source_path, count(*) AS rows, count(CASE WHEN best >= 1.0 - 1e-9 THEN 1 END) AS exact_rows, count(CASE WHEN best < 1.0 - 1e-9 THEN 1 END) AS near_rows
  FROM held LEFT JOIN best USING (id) GROUP BY 1, 2""",
        "p4_found": f"""WITH {_runs('records', 'row_idx', 'code', 3)}, k AS (SELECT row_idx, count(*) AS n, md5(string_agg(s, chr(1) ORDER BY s)) AS k FROM sh GROUP BY 1),
  cls AS (SELECT row_idx, n, min(row_idx) OVER (PARTITION BY k) AS c FROM k), rep AS (SELECT sh.row_idx, s FROM sh JOIN cls USING (row_idx) WHERE row_idx = c),
  inter AS (SELECT a.row_idx AS a, b.row_idx AS b, count(*) AS i FROM rep a JOIN rep b ON a.s = b.s AND a.row_idx < b.row_idx GROUP BY 1, 2),
  link AS (SELECT a, b FROM inter JOIN cls x ON x.row_idx = a JOIN cls y ON y.row_idx = b WHERE i / (x.n + y.n - i)::DOUBLE >= 0.7 - 1e-9),
  both_ways AS (SELECT x.row_idx AS a, y.row_idx AS b FROM link JOIN cls x ON x.c = a JOIN cls y ON y.c = b UNION ALL SELECT x.row_idx, y.row_idx FROM cls x JOIN cls y ON x.c = y.c AND x.row_idx < y.row_idx)
  SELECT least(a, b) AS row_idx_a, greatest(a, b) AS row_idx_b FROM both_ways""",
        "p6_found": rf"""WITH RECURSIVE named AS (SELECT DISTINCT id, {_path('meta.source_path')} AS p, CASE WHEN regexp_matches(meta.group_key, '[/\\]') THEN {_path('meta.group_key')} END AS g FROM chat_examples),
  entity AS (SELECT id, 'p:' || p AS e FROM named WHERE p IS NOT NULL UNION SELECT id, 'g:' || g FROM named WHERE g IS NOT NULL),
  link AS (SELECT DISTINCT x.id AS a, y.id AS b FROM entity x JOIN entity y ON x.e = y.e),
  reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
  SELECT min(b) AS first_id, a AS id FROM reach GROUP BY a HAVING min(b) <> a""",
    }
