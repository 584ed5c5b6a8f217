"""SQL twins of the queries that SQL can express, for DuckDB, written without the operators."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def unit_sql(*parts: str) -> str:
    """The number in (0, 1) that the leading 13 hex digits of an MD5 give."""
    return f"((('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


EXACT_DEDUP = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UP}', '{LOW}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)"""

# The function words of the quality rules.
_STOPS = """the of and to in a is that for it as was with be by on are this an or from at
der die das und zu den ist von mit ein eine nicht auf für im sich des dem auch als er es
de la le et les du un une est en que qui dans pour au par sur pas avec il elle
el los las y se no con su para del una lo""".split()
_STOP_LIST = ", ".join(f"'{w}'" for s in _STOPS for w in (s, s[0].upper() + s[1:]))


def _quality_ctes(docs: str) -> str:
    return f"""
q_w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM {docs}),
q_i AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM q_w WHERE len(w) >= 3),
q_t AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM q_i),
q_r AS (SELECT doc_id, count(DISTINCT i + k) AS r FROM q_t, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY doc_id),
q_m AS (SELECT q_w.doc_id, len(w) AS n_words, coalesce(length(list_aggregate(w, 'string_agg', '')), 0) AS word_chars,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words, len(ls) AS n_lines,
  len(list_filter(w, lambda x: x IN ({_STOP_LIST}))) AS n_stops,
  len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS n_open,
  len(list_filter(ls, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS n_bullets
  FROM q_w LEFT JOIN q_r USING (doc_id)),
q_b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q_m),
q_v AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 12 AND n_symbols / word_chars <= 0.05
  AND n_stops / n_words >= 0.04 AND n_dup_lines / n_lines <= 0.5 AND n_open / n_lines <= 0.5
  AND n_bullets / n_lines <= 0.9 AS kept FROM q_b)"""


QUALITY_RULES = f"WITH {_quality_ctes('documents')} SELECT * FROM q_v"


def _draw_sql(path: str, children: list[tuple[str, float]]) -> str:
    scores = ", ".join(f"{{'s': -ln({unit_sql('k', repr(path + '/' + c))}) / {w}::DOUBLE, 'p': '{path}/{c}'}}"
                       for c, w in children)
    return f"list_min([{scores}]).p"


def _tree_sql(extra: bool) -> str:
    regions = [("region0", 4), ("region1", 4)] + ([("region2", 1)] if extra else [])
    racks = " ".join(f"WHEN '/region{r}' THEN {_draw_sql(f'/region{r}', [('rack0', 2), ('rack1', 2)])}" for r in (0, 1))
    shards = " ".join(
        f"WHEN '/region{r}/rack{k}' THEN {_draw_sql(f'/region{r}/rack{k}', [(f'shard{4 * r + 2 * k}', 1), (f'shard{4 * r + 2 * k + 1}', 1)])}"
        for r in (0, 1) for k in (0, 1))
    return (f"SELECT *, regexp_extract(CASE b {shards} ELSE 'shard8' END, 'shard([0-9]+)$', 1)::INT AS s FROM "
            f"(SELECT *, CASE a {racks} ELSE a END AS b FROM (SELECT *, {_draw_sql('', regions)} AS a FROM %s))")


SHARDING = f"""
WITH tab AS (SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda a, z:
  CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
hexed AS (SELECT doc_id, text, list_transform(string_split(hex(encode(coalesce(text, ''))), ''),
  lambda c: instr('0123456789ABCDEF', c) - 1) AS h FROM documents),
summed AS (SELECT doc_id, coalesce(strlen(text), 0) + 1 AS size, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE
  xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h)), lambda i: CASE WHEN i % 2 = 0 THEN h[i + 2] ELSE h[i] END)),
  lambda a, x: xor(a >> 4, t[(xor(a, x) & 15) + 1])), 4294967295) END AS text_crc32,
  coalesce(doc_id::VARCHAR, 'null') AS k FROM hexed, tab),
now AS ({_tree_sql(False) % 'summed'}),
later AS ({_tree_sql(True) % '(SELECT doc_id, size, text_crc32, k, s AS shard FROM now)'}),
chunked AS (SELECT *, floor({unit_sql("'slot'", "k", "text_crc32::VARCHAR")} * ((SELECT count(*) FROM documents) // 160000 + 1)) AS c FROM later)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY c, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, s AS grown_shard
FROM chunked"""

MIXING = f"""
WITH RECURSIVE chars AS (SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS chars FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN chars > 0 THEN 1.0::DOUBLE / (SELECT count(*) FROM chars)::DOUBLE * (SELECT sum(chars) FROM chars) / chars
  ELSE 1.0::DOUBLE END AS m FROM chars),
cdf(source, m, k, p, total) AS (SELECT source, m, 0, exp(-m), exp(-m) FROM rates
  UNION ALL SELECT source, m, k + 1, p * m / (k + 1), total + p * m / (k + 1) FROM cdf WHERE k < ceil(m + 12 * sqrt(m) + 40)),
steps AS (SELECT source, list(total ORDER BY k) AS cdf FROM cdf GROUP BY source),
drawn AS (SELECT d.*, coalesce(doc_id::VARCHAR, 'null') AS name, len(list_filter(cdf, lambda c: c <= {
    unit_sql("'mix-1'", "'copies'", "'1'", "coalesce(doc_id::VARCHAR, 'null')")})) AS mix_copies
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source),
copies AS (SELECT *, unnest(range(1, mix_copies + 1)) AS mix_copy FROM drawn)
SELECT doc_id, text, lang, source, n_chars, mix_copy::INT AS mix_copy, mix_copies::INT AS mix_copies,
  ('0x' || substr(md5(concat_ws('|', 'mix-1', 'order', name, mix_copy)), 1, 15))::BIGINT AS mix_order FROM copies"""

CHAT = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS segment FROM t),
p AS (SELECT *, conv_id // 2 AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side,
  row_number() OVER w - 1 AS position, coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
l AS (SELECT pair_id, position, count(DISTINCT side) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same,
  count(DISTINCT side) AS sides FROM p GROUP BY pair_id, position),
c AS (SELECT pair_id, coalesce(min(position) FILTER (NOT same), max(position) + 1) AS shared, max(sides) = 2 AS paired FROM l GROUP BY pair_id),
k AS (SELECT pair_id, sum(length(segment)) AS prompt_chars FROM p JOIN c USING (pair_id) WHERE side = 'chosen' AND position < shared GROUP BY pair_id)
SELECT pair_id, CASE WHEN NOT paired THEN 'unpaired' WHEN position < shared THEN 'prompt' ELSE side END AS part,
  position, role, segment, (before - CASE WHEN paired AND position >= shared THEN coalesce(prompt_chars, 0) ELSE 0 END)::BIGINT AS char_start,
  length(segment) AS n_chars, paired AND position >= shared AND role = 'assistant' AS trained
FROM p JOIN c USING (pair_id) LEFT JOIN k USING (pair_id)
WHERE NOT paired OR position >= shared OR side = 'chosen'"""


def _crc_sql(value: str) -> str:
    """CRC-32 of the ASCII text of ``value``, beside the table ``tab`` of the sixteen half-byte steps."""
    return (f"xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({value}, ''), "
            "lambda c: [ascii(c) & 15, ascii(c) >> 4]))), lambda a, x: xor(a >> 4, t[(xor(a, x) & 15) + 1])), 4294967295)")


_CRC_TABLE = """tab AS (SELECT list_transform(range(16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda a, z:
  CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)"""


def _encoded_sql(text: str) -> str:
    return " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
                       for c in ("doc_id", "source", "lang", "n_chars", text))


def _levels_sql(name: str, group: str, start: str) -> str:
    """Nodes and their siblings of the trees that grow from ``start`` (group, pos, digest, n)."""
    return f"""{name}({group}, lvl, pos, digest, n) AS (SELECT {group}, 0, pos, digest, n FROM {start} UNION ALL
  SELECT {group}, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1
  GROUP BY {group}, lvl + 1, pos // 3, (n + 2) // 3),
{name}_sib AS (SELECT a.{group}, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') || ',' ||
  coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS sib
  FROM {name} a LEFT JOIN {name} b ON a.{group} IS NOT DISTINCT FROM b.{group} AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 AND a.pos <> b.pos
  WHERE a.n > 1 GROUP BY a.{group}, a.lvl, a.pos)"""


MERKLE = f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (SELECT doc_id, source, sha256({_encoded_sql('text')}) AS leaf, CASE WHEN {_crc_sql('doc_id::VARCHAR')} % 2 = 0
  THEN sha256({_encoded_sql("replace(text, chr(10), '')").replace("WHEN replace(text, chr(10), '') IS", "WHEN text IS")}) END AS claim
  FROM documents, tab),
leaves AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS n FROM hashed),
{_levels_sql('low', 'source', 'leaves')},
subs AS (SELECT 0 AS one, source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
{_levels_sql('high', 'one', 'subs')},
path_low AS (SELECT d.source, d.pos, list(sib ORDER BY lvl) FILTER (sib IS NOT NULL) AS path FROM leaves d LEFT JOIN low_sib s
  ON d.source IS NOT DISTINCT FROM s.source AND s.pos = d.pos // (3 ** s.lvl)::BIGINT GROUP BY d.source, d.pos),
path_high AS (SELECT d.source, d.digest AS subroot, list(sib ORDER BY lvl) FILTER (sib IS NOT NULL) AS path FROM subs d LEFT JOIN high_sib s
  ON s.pos = d.pos // (3 ** s.lvl)::BIGINT GROUP BY d.source, d.digest),
paths AS (SELECT l.doc_id, l.leaf, coalesce(l.claim, l.leaf) AS claim, subroot, (SELECT digest FROM high WHERE n = 1) AS root,
  list_concat(a.path, b.path) AS path
  FROM leaves l JOIN path_low a ON l.source IS NOT DISTINCT FROM a.source AND l.pos = a.pos
  JOIN path_high b ON l.source IS NOT DISTINCT FROM b.source),
folds AS (SELECT *, list_reduce(list_prepend(claim, path), lambda a, x: sha256(split_part(x, ',', 1) || a || split_part(x, ',', 2))) AS folded_root FROM paths)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), ',', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folds"""

TRIE = f"""
WITH {_CRC_TABLE},
turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
marked AS (SELECT c, turn, length(text) AS chars, substr(sha256(strlen(role) || ':' || role || strlen(text) || ':' || text), 1, 32) AS mark FROM turns),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, mark) - 1 AS pos FROM marked),
convs AS (SELECT c, count(*) AS size, c - c % 100 AS base FROM turns GROUP BY c),
heads AS (SELECT v.*, {_crc_sql('v.c::VARCHAR')} % 6 AS h, coalesce(w.size, 0) AS base_size FROM tab, convs v LEFT JOIN convs w ON v.base = w.c),
rebuilt AS (SELECT v.c, pos + 1 AS d, mark, chars FROM heads v JOIN placed p ON p.c = v.base WHERE pos < h
  UNION ALL SELECT v.c, pos - h + least(h, base_size) + 1, mark, chars FROM heads v JOIN placed p ON p.c = v.c WHERE pos >= h),
seqs AS (SELECT convs.c, coalesce(list(mark ORDER BY d) FILTER (mark IS NOT NULL), []) AS marks,
  coalesce(list(chars ORDER BY d) FILTER (mark IS NOT NULL), []) AS chars FROM convs LEFT JOIN rebuilt USING (c) GROUP BY convs.c),
steps AS (SELECT *, unnest(range(0, len(marks) + 1)) AS d FROM seqs),
nodes AS (SELECT d, md5(array_to_string(marks[:d], '')) AS k, CASE WHEN d > 0 THEN md5(array_to_string(marks[:d - 1], '')) END AS up, any_value(marks[:d]) AS marks,
  min(c) AS conv_id, count(*) AS n_convs, coalesce(any_value(chars[d]), 0) * (count(*) - 1) AS own,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(marks) = d), '')) AS ends_sha256 FROM steps GROUP BY 1, 2, 3),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
lines AS (SELECT n.*, unnest(range(0, d + 1)) AS top, n_children FROM nodes n LEFT JOIN kids USING (d, k)),
under AS (SELECT top AS d, md5(array_to_string(marks[:top], '')) AS k, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(own) AS saved FROM lines GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN under USING (d, k) LEFT JOIN kids USING (d, k) LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.up"""

ORACLES = {
    "op11_conversation_prefix_trie": TRIE,
    "op12_merkle_manifest": MERKLE,
    "op4_sharding": SHARDING,
    "op5_chat_formatting": CHAT,
    "op6_source_mixing": MIXING,
    "op8_exact_dedup": EXACT_DEDUP,
    "op9_quality_rules": QUALITY_RULES,
}
