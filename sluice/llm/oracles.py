"""SQL of the operators' queries that SQL can express; the others are tested by brute force."""

from __future__ import annotations

_CHAT = r"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), laid AS (
    SELECT *, regexp_replace(text, '([<\[])(~*)(\|[a-z_]+\|>|/?s>|/?INST\]|</?SYS>>)', '\1~\2\3', 'g') AS escaped
    FROM told
), chats AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
        sum(length(role) + length(escaped) + length('<|turn|>') + length('<|body|>') + length('<|end|>')) AS chars
    FROM laid GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt)::BIGINT AS loss_chars,
    sha256(learnt) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM chats
"""

_RULES = r"""
WITH read AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), split AS (
    SELECT r, doc_id, source, text,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM read
), windows AS (
    SELECT r, i, words[i:i + 4] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM split)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) AS t(k) GROUP BY r
), counted AS (
    SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split LEFT JOIN covered USING (r)
), ruled AS (
    SELECT *, n_words < 10 AS few, 100 * n_repeat_words > 20 * n_words AS repeated,
        n_symbols > 0.1::DOUBLE * n_words AS symbols, n_dup_lines > 10 AS same
    FROM counted
), hosts AS (
    SELECT source, count(*) AS n, unnest([
        {'rule': 1, 'k': sum(few::INT)}, {'rule': 2, 'k': sum(repeated::INT)},
        {'rule': 3, 'k': sum(symbols::INT)}, {'rule': 4, 'k': sum(same::INT)}]) AS f
    FROM ruled GROUP BY source
), prior AS (
    SELECT f.rule AS rule, avg(f.k / n) AS m, greatest(1.0, least(10000.0, avg(f.k / n) * (1 - avg(f.k / n))
        / greatest(var_pop(f.k / n) - greatest(avg(f.k / n) * avg(1 / n) - avg((f.k / n) * (f.k / n) / n), 0.0), 1e-9) - 1)) AS w
    FROM hosts GROUP BY f.rule
), verdicts AS (
    SELECT source, max((f.k + m * w) / (n + w)) > 0.5 AS host_rejected
    FROM hosts JOIN prior ON f.rule = prior.rule GROUP BY source
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, few OR repeated AS base_failed,
    NOT (few OR repeated OR (host_rejected AND (symbols OR same))) AS kept, host_rejected
FROM ruled JOIN verdicts ON ruled.source IS NOT DISTINCT FROM verdicts.source
"""

ORACLES = {"op2_chat_format": _CHAT, "op3_host_rules": _RULES}

# Both rounds and the final assignment are the same steps over the codebook before.
_FINITE = """
SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
"""


def _assigned(name: str, book: str) -> str:
    """Each vector's parts, the index of the nearest entry of a codebook, and the squared distance."""
    return f"""{name} AS (
    SELECT p.r, p.part, any_value(p.w) AS w, min(d.d) AS d, arg_min(d.entry, d.d * 64 + d.entry) AS entry
    FROM parts p JOIN (
        SELECT a.r, a.part, b.entry, (a.w[1] - b.w[1]) ** 2 + (a.w[2] - b.w[2]) ** 2
            + (a.w[3] - b.w[3]) ** 2 + (a.w[4] - b.w[4]) ** 2 AS d
        FROM parts a JOIN {book} b USING (part)
    ) d USING (r, part) GROUP BY p.r, p.part
)"""


def _moved(name: str, book: str, assigned: str) -> str:
    means = ", ".join(f"floor(sum(w[{j}])::DECIMAL(38,0) / count(*))::BIGINT" for j in range(1, 5))
    return f"""{name} AS (
    SELECT part, entry, coalesce(m.w, b.w) AS w FROM {book} b LEFT JOIN (
        SELECT part, entry, [{means}] AS w FROM {assigned} GROUP BY part, entry) m USING (part, entry)
)"""


_CODES = f"""
WITH kept AS (SELECT *, row_number() OVER (ORDER BY vec_id) AS r FROM ({_FINITE})
), parts AS (
    SELECT r, part, list_transform(range(1, 5), lambda j: floor(256 * v[part * 4 + j])::BIGINT) AS w
    FROM kept, range(16) t(part)
), book0 AS (SELECT part, r - 1 AS entry, w FROM parts WHERE r <= 64
), {_assigned('near0', 'book0')}, {_moved('book1', 'book0', 'near0')},
{_assigned('near1', 'book1')}, {_moved('book2', 'book1', 'near1')}, {_assigned('near2', 'book2')},
coded AS (
    SELECT r, string_agg(lpad(printf('%x', entry::BIGINT), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM near2 GROUP BY r
), books AS (
    SELECT sha256(string_agg(array_to_string(w, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""

_NEAREST = f"""
WITH kept AS (SELECT * FROM ({_FINITE}) WHERE len(list_filter(v, lambda x: x <> 0)) > 0
), apart AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v),
        lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
    FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM apart
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLES |= {"op11_grid_codes": _CODES, "op13_vp_trees": _NEAREST}
