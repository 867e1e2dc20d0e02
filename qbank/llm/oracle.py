"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from qbank.llm.quality import RULES, STOP_WORDS

WORD = r"[^\x20\x09-\x0D]+"

#: per-document measures of the quality rules, from the table ``{src}``
QUALITY_CTE = r"""
ws AS (SELECT doc_id, coalesce(text, '') AS t,
              regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {src}),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM ws WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
rw AS (SELECT doc_id, sum(least(8, coalesce(nx - i, 8)))::BIGINT AS n FROM rep GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)),
                                  lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM ws),
meas AS (
  SELECT ws.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rw.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words
  FROM ws JOIN ln USING (doc_id) LEFT JOIN rw USING (doc_id)),
verdict AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio
  FROM meas),
quality AS (SELECT *, (NOT base_failed AND {rules}) AS kept FROM verdict)
"""


def quality_cte(src: str) -> str:
    rules = " AND ".join(f"{m} {op} {v}" for m, lo, hi in RULES
                         for op, v in ((">=", lo), ("<=", hi)) if v is not None)
    return QUALITY_CTE.format(src=src, stop=", ".join(f"'{w}'" for w in STOP_WORDS), rules=rules)


OP9 = f"""WITH {quality_cte("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM quality"""

OP1 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
FROM t WINDOW g AS (PARTITION BY text)
"""

#: per-document figures of the mixture, from the table ``{src}`` (doc_id, source, text)
MIX_CTE = r"""
sz AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
       FROM {src}),
src0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sz GROUP BY source),
src1 AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
                (2 * source_size)::DOUBLE AS cap FROM src0),
src2 AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
                    - (sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap))
                   / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM src1),
lv AS (SELECT arg_min(lvl, cap / weight) AS lvl FROM src2 WHERE lvl * weight <= cap),
tg AS (SELECT source, source_size, least(cap, lv.lvl * weight) AS target FROM src2, lv),
ex AS (SELECT sz.*, tg.source_size, tg.target,
              CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
              (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR), 1, 13))::BIGINT
               + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
       FROM sz JOIN tg ON sz.source IS NOT DISTINCT FROM tg.source),
fr AS (SELECT *, least(2.0::DOUBLE, rate) - floor(least(2.0::DOUBLE, rate)) AS p,
              floor(least(2.0::DOUBLE, rate)) AS certain FROM ex),
od AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1.0::DOUBLE - u)) / (p / (1.0::DOUBLE - p)) END AS odds FROM fr),
mid AS (SELECT *, sum(CASE WHEN odds IS NULL THEN 0 ELSE size END)
                    OVER (PARTITION BY source ORDER BY odds / (1.0::DOUBLE + odds) NULLS LAST, doc_id, size
                          ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE AS middle,
               sum(certain * size) OVER (PARTITION BY source) AS certain_size FROM od),
mix AS (SELECT *, (certain + CASE WHEN odds IS NOT NULL AND middle <= target - certain_size THEN 1 ELSE 0 END)::BIGINT
                  AS copies FROM mid)
"""

OP7 = f"""WITH {MIX_CTE.format(src="documents")}
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mix
"""

OP5 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS esc FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + esc + 24)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP10 = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM t WHERE len(w) >= 13)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM win)
        WHERE least < doc_id),
wd AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM t),
last AS (SELECT wd.doc_id, wd.i, word, r.i AS start FROM wd ASOF LEFT JOIN rep r
         ON wd.doc_id = r.doc_id AND wd.i >= r.i),
left_ AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) FILTER (start IS NULL OR i - start > 12) AS kept,
                 count(*) AS n, count(*) FILTER (start IS NOT NULL AND i - start <= 12) AS gone
          FROM last GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN left_ USING (doc_id)
"""

#: CRC-32 has no function here: the table of its 256 steps, then a fold over the digits
OP11 = r"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
                      CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS tab
        FROM range(256) AS r(i)),
d AS (SELECT *, CASE WHEN doc_id IS NOT NULL AND xor(4294967295, list_reduce(
                  list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1),
                                                          lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
                  lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) % 5 = 0
                  THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS seen,
             coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
             || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')
             AS head
      FROM documents, crc),
f AS (SELECT doc_id, coalesce('1' || source, '0') AS grp,
             sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(head || coalesce(strlen(seen) || ':' || seen, '-')) AS seen_leaf FROM d),
leaves AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                  count(*) OVER (PARTITION BY grp) AS size FROM f),
nodes AS (SELECT 0 AS lvl, grp, place, size, leaf AS digest FROM leaves
          UNION ALL
          SELECT lvl + 1, grp, place // 16, any_value((size + 15) // 16), sha256(string_agg(digest, '' ORDER BY place))
          FROM nodes WHERE size > 1 GROUP BY lvl, grp, place // 16),
tops AS (SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS size
         FROM nodes WHERE size = 1),
over_ AS (SELECT 0 AS lvl, place, size, digest FROM tops
          UNION ALL
          SELECT lvl + 1, place // 16, any_value((size + 15) // 16), sha256(string_agg(digest, '' ORDER BY place))
          FROM over_ WHERE size > 1 GROUP BY lvl, place // 16),
sib AS (SELECT lvl, grp, place,
               {'l': coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
                'r': coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')} AS s
        FROM nodes WHERE size > 1 WINDOW w AS (PARTITION BY lvl, grp, place // 16 ORDER BY place)),
osib AS (SELECT lvl, place,
                {'l': coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
                 'r': coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')} AS s
         FROM over_ WHERE size > 1 WINDOW w AS (PARTITION BY lvl, place // 16 ORDER BY place)),
lo AS (SELECT l.grp, l.place, list(s ORDER BY lvl) AS p FROM leaves l
       JOIN sib ON sib.grp = l.grp AND sib.place = l.place // (1::BIGINT << (4 * lvl)) GROUP BY l.grp, l.place),
hi AS (SELECT t.grp, list(s ORDER BY lvl) AS p FROM tops t
       JOIN osib ON osib.place = t.place // (1::BIGINT << (4 * lvl)) GROUP BY t.grp),
path AS (SELECT l.*, t.digest AS subroot, (SELECT digest FROM over_ WHERE size = 1) AS root,
                list_concat(coalesce(lo.p, []), coalesce(hi.p, [])) AS p
         FROM leaves l JOIN tops t USING (grp) LEFT JOIN lo ON lo.grp = l.grp AND lo.place = l.place
         LEFT JOIN hi ON hi.grp = l.grp),
done AS (SELECT *, list_reduce(list_prepend({'l': seen_leaf, 'r': ''}, p), lambda a, b:
                     {'l': sha256(b.l || a.l || b.r), 'r': ''}).l AS folded_root FROM path)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(p, lambda x: x.l || x.r), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified FROM done
"""

ORACLES = {
    "op11_merkle_manifest": OP11,
    "op10_substring_dedup": OP10,
    "op1_exact_dedup": OP1,
    "op5_chat_format": OP5,
    "op7_source_mixing": OP7,
    "op9_quality_rules": OP9,
}
