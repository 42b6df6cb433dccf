"""DuckDB SQL for the contract queries that SQL can express.

XXH64 fingerprints, tokenizers and trained models are not expressible; tests hold those queries against brute force,
exact round trips or held-out accuracy.
"""

from __future__ import annotations

from pixelmill.llm.quality_rules import BOILERPLATE, MENU_LINE, QualityParams
from pixelmill.llm.url_model import ALPHABET, UrlParams

GAP, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"


def _quality(p: QualityParams = QualityParams()) -> str:
    count = lambda pattern: f"len(regexp_extract_all(line, '{pattern}'))"
    words = f"len(string_split_regex(line, '{GAP}'))"
    phrases = "|".join(BOILERPLATE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS w FROM d),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM starts),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again WHERE n > 1) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
judged AS (SELECT doc_id, line, {count("[#*$%&<>~^]")} > {p.max_symbol_share} * length(line) OR {count("[!?]{2,}")} > {p.max_shout_share} * {words}
  OR {count("[|»›→]")} > {p.max_bar_share} * {words} OR length(line) <= {p.max_menu_chars} AND regexp_matches(line, '{MENU_LINE}') OR regexp_matches(line, '(?i){phrases}') OR NOT regexp_matches(line, '\\p{{L}}|\\p{{N}}') AS bad
  FROM lines WHERE regexp_matches(line, '{WORD}')),
shares AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, coalesce(sum(length(line)) FILTER (bad), 0) AS lost, sum(length(line)) AS size FROM judged GROUP BY 1),
stats AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost, coalesce(size, 0) AS size
  FROM w LEFT JOIN shares USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {p.min_words} OR 100 * n_repeat_words > {p.max_repeat_percent} * n_words) AND (size = 0 OR lost::DOUBLE / size <= {p.max_removed_share}) AS kept FROM stats"""


def _urls(p: UrlParams = UrlParams()) -> str:
    rules = sorted(p.rules, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, path: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{path}')"
    name = "CASE " + " ".join(f"WHEN {fits(h, x)} THEN '{h}{x}'" for _, h, x in rules) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, x)} THEN '{v}'" for v, h, x in rules) + " END"
    k = p.order
    models = []
    for side in ("allow", "block"):
        models.append(f"{side}_p0 AS (SELECT DISTINCT gram, {1.0 / len(ALPHABET)}::DOUBLE AS p FROM grams)")
        for o in range(k + 1):
            suffix = f"substr(gram, {k + 1 - o}, {o + 1})"
            models.append(f"{side}_s{o} AS (SELECT {suffix} AS g, count(*) AS n FROM grams WHERE by_rule = '{side}' AND NOT held GROUP BY 1)")
            models.append(f"{side}_c{o} AS (SELECT substr(g, 1, {o}) AS c, sum(n) AS total, count(*) AS kinds FROM {side}_s{o} GROUP BY 1)")
            models.append(
                f"{side}_p{o + 1} AS (SELECT b.gram, CASE WHEN total IS NULL THEN p ELSE (coalesce(s.n, 0) + kinds * p) / (total + kinds) END AS p FROM {side}_p{o} b "
                f"LEFT JOIN {side}_s{o} s ON s.g = substr(b.gram, {k + 1 - o}, {o + 1}) LEFT JOIN {side}_c{o} c ON c.c = substr(b.gram, {k + 1 - o}, {o}))"
            )
    return f"""WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
r AS (SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
hp AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
base AS (SELECT *, {name} AS rule, {verdict} AS by_rule, '{"^" * k}' || regexp_replace(regexp_replace(lower(url), '[0-9]', '0', 'g'), '[^a-z0./:\\-_?=&%#~]', '*', 'g') AS s,
  ('0x' || substr(md5(url), 1, 8))::BIGINT % {p.heldout_mod} = 0 AND {verdict} IS NOT NULL AS held FROM hp),
spots AS (SELECT *, unnest(range(1, length(s) - {k} + 1)) AS i FROM base WHERE length(s) > {k}),
grams AS (SELECT page_id, url, by_rule, held, substr(s, i, {k + 1}) AS gram FROM spots),
{", ".join(models)},
scores AS (SELECT page_id, url, round(avg(ln(a.p) - ln(b.p)), 6) AS score, max(by_rule) FILTER (held) AS known FROM grams JOIN allow_p{k + 1} a USING (gram) JOIN block_p{k + 1} b USING (gram) GROUP BY 1, 2),
means AS (SELECT round(coalesce((avg(score) FILTER (known = 'allow') + avg(score) FILTER (known = 'block')) / 2, 0), 6) AS t FROM scores)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN coalesce(score, 0) >= t THEN 'allow' ELSE 'block' END) AS verdict
FROM base LEFT JOIN scores USING (page_id, url), means"""


TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20"""

CHAT = """WITH x AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
n AS (SELECT *, row_number() OVER o AS k, coalesce(lag(role) OVER o <> role, true) AS first,
  length(text) + length(regexp_replace(text, '[^<\\\\]', '', 'g')) AS escaped, length(role) + length(regexp_replace(role, '[^<\\\\\\n]', '', 'g')) AS escaped_role
  FROM x WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(escaped) + sum(CASE WHEN first THEN 24 + escaped_role ELSE 10 END))::BIGINT AS formatted_chars FROM n GROUP BY conv_id"""

SUBSTRINGS = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
starts AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
windows AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM again),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op2_url_filter": _urls(),
    "op3_topk_search": TOP_K,
    "op4_chat_format": CHAT,
    "op5_substring_dedup": SUBSTRINGS,
}
