"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _space_words(text: str) -> str:
    return f"regexp_extract_all(coalesce({_LOWER.format(text)}, ''), '[^\\x20\\x09-\\x0D]+')"


def _item_words(text: str) -> str:
    return f"regexp_extract_all(coalesce({_LOWER.format(text)}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


CONTAMINATION = f"""
WITH items AS (SELECT cast(item_id AS varchar) item_id, {_item_words('text')} w FROM benchmark),
windows AS (SELECT DISTINCT item_id, l, w[i:i + l - 1] win
  FROM (SELECT item_id, w, least(10, len(w)) l FROM items WHERE len(w) > 0) x, unnest(range(1, len(w) - l + 2)) t(i)),
docs AS (SELECT doc_id, {_item_words('text')} w FROM documents),
places AS (SELECT doc_id, i, l, w[i:i + l - 1] win
  FROM docs, (SELECT DISTINCT l FROM windows) s, unnest(range(1, len(w) - l + 2)) t(i) WHERE len(w) >= l),
hits AS (SELECT doc_id, i, l, item_id FROM places JOIN windows USING (l, win)),
words AS (SELECT doc_id, count(DISTINCT i + k) n_hit FROM hits, unnest(range(l)) t(k) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT item_id) FILTER (item_id IS NOT NULL)) ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, cast(len(d.w) AS bigint) n_words, coalesce(n_hit, 0) n_hit,
  cast(coalesce(len(ids), 0) AS bigint) n_items, sha256(coalesce(array_to_string(ids, ','), '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

JACCARD_COMPONENTS = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_space_words('text')} w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') shingle
  FROM docs, unnest(range(1, len(w) - least(3, len(w)) + 2)) t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id a, b.doc_id b, count(*) inter
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * inter >= 90 * (x.n + y.n - inter)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id other FROM docs
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n), 0) n_shingles, min(other) component_id
FROM docs d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id
"""

LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) l FROM documents),
places AS (SELECT doc_id, i - 1 line_no, list_sort(list_distinct({_space_words('l[i]')})) w
  FROM docs, unnest(range(1, len(l) + 1)) t(i)),
lines AS (SELECT * FROM places WHERE len(w) > 0),
classes AS (SELECT w, len(w) n, row_number() OVER (ORDER BY min((doc_id, line_no))) id FROM lines GROUP BY w),
words AS (SELECT id, n, unnest(w) word FROM classes),
often AS (SELECT word, count(*) df FROM words GROUP BY word),
ordered AS (SELECT id, n, word, row_number() OVER (PARTITION BY id ORDER BY df, word) place
  FROM words JOIN often USING (word)),
prefix AS (SELECT * FROM ordered WHERE place <= n - ceil(0.8 * n) + 1),
pairs AS (SELECT DISTINCT a.id a, b.id b FROM prefix a JOIN prefix b ON a.word = b.word AND b.id < a.id
  AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
late AS (SELECT DISTINCT a FROM pairs JOIN classes x ON x.id = a JOIN classes y ON y.id = b
  WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (x.n + y.n)),
verdicts AS (SELECT l.doc_id, l.line_no, c.id IN (SELECT a FROM late)
    OR row_number() OVER (PARTITION BY c.id ORDER BY l.doc_id, l.line_no) > 1 removed
  FROM lines l JOIN classes c ON c.w = l.w),
by_doc AS (SELECT doc_id, count(*) n_lines, count(*) FILTER (removed) n_removed,
    array_to_string(list(line_no ORDER BY line_no) FILTER (removed), ',') gone
  FROM verdicts GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) n_lines, coalesce(n_removed, 0) n_removed, coalesce(gone, '') removed
FROM docs d LEFT JOIN by_doc USING (doc_id)
"""
