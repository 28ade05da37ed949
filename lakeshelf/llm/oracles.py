"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lakeshelf.llm.license_scan import COVER, K, NEAR, TEMPLATES
from lakeshelf.llm.secret_scan import BASE_RULES, RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: DuckDB's expressions know no lookahead and no reference to a group, so a private key's heading, END line and base64 lines are found apart.
_KEY_HEAD = "-----BEGIN ([A-Z ]{0,40})PRIVATE KEY-----"
_BLANK = r"(?:[\x09-\x0D\x20]|\\[nrt])"
_KEY_BODY = rf"^((?:(?:[\x09-\x0D\x20\x22'+>#*,]|\\[nrt])*(?:(?:Proc-Type|DEK-Info):[^\r\n\\]*|[A-Za-z0-9+/=]{{16,}}))*)"
_KEY_LAST = rf"{_KEY_BODY[:-1]}{_BLANK}+[A-Za-z0-9+/]+={{0,2}})[\x20\x09]*(?:[\r\n\x22'\\]|$)"


def _secrets() -> str:
    patterns = [(i, r.kind, _KEY_HEAD if r.kind == "pem" else r.pattern, 1 if r.kind == "pem" else r.group, r.least) for i, r in enumerate(RULES)]
    per_rule = " UNION ALL ".join(
        f"""SELECT row, t, {i} AS nth, {_quoted(kind)} AS kind, unnest(range(len(m))) AS i, unnest(m) AS match, unnest(g) AS value,
                   unnest(string_split_regex(t, {_quoted(pattern)})[1:len(m)]) AS gap, {least} AS least
            FROM (SELECT row, t, regexp_extract_all(t, {_quoted(pattern)}, 0) AS m,
                         regexp_extract_all(t, {_quoted(pattern)}, {group}) AS g FROM docs) WHERE len(m) > 0"""
        for i, kind, pattern, group, least in patterns
    )
    base = ", ".join(_quoted(r.kind) for r in BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (kind = {_quoted(r.kind)}) AS n_{r.kind}" for r in BASE_RULES)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth)"
    last, body = (f"regexp_extract(rest, {_quoted(p)}, 1)" for p in (_KEY_LAST, _KEY_BODY))
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
    pieces AS ({per_rule}),
    ends AS (SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY row, nth ORDER BY i)::BIGINT AS stop FROM pieces),
    keys AS (
        SELECT row, nth, kind, stop - length(match) AS start, stop AS head_stop, substr(t, stop + 1) AS rest,
               '-----END ' || value || 'PRIVATE KEY-----' AS own
        FROM ends WHERE kind = 'pem'
    ), placed AS (SELECT *, strpos(rest, own) AS own_at, strpos(rest, '-----BEGIN ') AS next_at FROM keys),
    spans AS (
        SELECT row, nth, kind, stop - length(match) AS start, stop FROM ends WHERE kind <> 'pem' AND length(value) >= least
        UNION ALL
        SELECT row, nth, kind, start, head_stop + CASE
            WHEN own_at > 0 AND (next_at = 0 OR own_at < next_at) THEN own_at - 1 + length(own)
            ELSE greatest(length({last}), length({body})) END
        FROM placed
    ),
    found AS (SELECT row, {counts}, {listed} FILTER (kind IN ({base})) AS base, {listed} AS spans FROM spans GROUP BY row)
    SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN found USING (row)
    """


# Sources fill up in order of 3 * size / weight: those before the first that does not reach its bound get the bound.
_MIX = r"""
    WITH docs AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
               ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
        FROM docs GROUP BY source
    ), shares AS (
        SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS left_over,
               sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS weights
        FROM sources
        WINDOW earlier AS (ORDER BY source_size / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), capped AS (
        SELECT *, weight * left_over > 3 * source_size * weights AS at_bound FROM shares
    ), rate AS (
        SELECT max_by(left_over, left_over) FILTER (NOT at_bound) AS left_over, max_by(weights, left_over) FILTER (NOT at_bound) AS weights FROM capped
    ), targets AS (
        SELECT source, source_size,
               CASE WHEN at_bound THEN (3 * source_size)::DOUBLE
                    ELSE (weight * rate.left_over)::DOUBLE / rate.weights::DOUBLE END AS target
        FROM capped, rate
    ), placed AS (
        SELECT doc_id, size, source_size, target, round_even(target, 0)::BIGINT AS wanted,
               coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source
    )
    SELECT doc_id, size, source_size, target,
           (size * (wanted // source_size + (wanted % source_size > 0 AND 2 * before + size <= 2 * (wanted % source_size))::BIGINT))::BIGINT AS taken
    FROM placed
"""



def _licenses() -> str:
    grams = []
    for i, t in enumerate(TEMPLATES):
        words = t.words.split()
        for at in range(len(words) - K + 1):
            gram = " ".join(words[at : at + K])
            grams.append(f"({_quoted(gram)}, {i}, {at}, {len(words) - K + 1}, {t.exact}, {_quoted(t.label)})")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH templates(gram, template, at_word, size, exact, label) AS (VALUES {", ".join(grams)}),
    docs AS (
        SELECT row_number() OVER () AS row, doc_id,
               coalesce(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
        FROM documents
    ), words AS (SELECT row, unnest(range(len(w))) AS place, unnest(w) AS word FROM docs),
    pairs AS (SELECT row, place, word || ' ' || lead(word) OVER (PARTITION BY row ORDER BY place) AS gram FROM words),
    diagonals AS (
        SELECT row, template, size, exact, label, place - at_word AS diagonal, count(*) AS votes, min(place) AS low, max(place) AS high
        FROM pairs JOIN templates USING (gram) GROUP BY ALL
    ), fresh AS (
        SELECT *, coalesce(exact OR diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) > {NEAR}, true)::INTEGER AS is_new
        FROM diagonals
    ), numbered AS (SELECT *, sum(is_new) OVER (PARTITION BY row, template ORDER BY diagonal) AS span FROM fresh),
    spans AS (
        SELECT row, size, exact, label, least(sum(votes) / size::DOUBLE, 1.0) AS share, sum(votes) AS votes, min(low) AS low, max(high) AS high
        FROM numbered GROUP BY row, template, size, exact, label, span
    ), found AS (
        SELECT row, max(share) AS best, count(*) FILTER (exact AND votes = size) AS n_base,
               min(low) FILTER (exact AND votes = size) AS first_word, max(low) FILTER (exact AND votes = size) AS last_word,
               list_sort(list_distinct(list(label) FILTER (exact AND votes = size))) AS base_labels,
               list_sort(list_distinct(list(label) FILTER (CASE WHEN exact THEN votes = size ELSE share >= {COVER} AND high - low < 2 * size END))) AS labels
        FROM spans GROUP BY row
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
           coalesce(array_to_string(base_labels, ','), '') AS base_labels, coalesce(array_to_string(labels, ','), '') AS labels,
           coalesce(best, 0)::DOUBLE AS score
    FROM docs LEFT JOIN found USING (row)
    """


_REPEATS = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
    ), windows AS (
        SELECT row, doc_id, i, array_to_string(w[i : i + 12], ' ') AS win
        FROM (SELECT row, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE doc_id IS NOT NULL)
    ), least_doc AS (SELECT win, min(doc_id) AS least_id FROM windows GROUP BY win),
    gone AS (
        SELECT DISTINCT row, unnest(range(i, i + 13)) AS i FROM windows JOIN least_doc USING (win) WHERE doc_id > least_id
    ), words AS (SELECT row, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
    kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (row, i) GROUP BY row),
    counts AS (SELECT row, count(*) AS n_removed FROM gone GROUP BY row)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM docs LEFT JOIN counts USING (row) LEFT JOIN kept USING (row)
"""

_NEAR_TEXT = r"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, coalesce(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
        FROM documents
    ), sets AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)
    ), sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter
        FROM sets AS x JOIN sets AS y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
    ), links AS (
        SELECT a, b FROM common JOIN sizes AS m ON a = m.doc_id JOIN sizes AS n ON b = n.doc_id WHERE 100 * inter >= 75 * (m.n + n.n - inter)
    ), steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (
        SELECT a, b FROM steps
        UNION SELECT reached.a, steps.b FROM reached JOIN steps ON reached.b = steps.a
    ), classes AS (SELECT a AS doc_id, min(b) AS least_id FROM reached GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least_id, doc_id) AS component_id, coalesce(least_id, doc_id) = doc_id AS kept
    FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN classes USING (doc_id)
"""

# Lists are compared in double precision; a component that is null or not finite takes its vector out.
_NEAR_VECTORS = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM usable AS x JOIN usable AS y
            ON x.label = y.label AND len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
        WHERE list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v) * list_dot_product(y.v, y.v)) >= 0.93
    ), reached AS (
        SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
    ), classes AS (SELECT a AS vec_id, min(b) AS least_id FROM reached GROUP BY a),
    counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least_id, vec_id) AS component_id, coalesce(least_id, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN classes USING (vec_id)
"""

_HARD_NEGATIVES = """
    WITH used AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
    ), anchors AS (SELECT * FROM used WHERE vec_id % 100 = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
               list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM anchors AS a JOIN used AS r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
"""

_COLLOCATIONS = r"""
    WITH pieces AS (
        SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
              FROM documents)
    ), counts AS (
        SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
        FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, range(1, 5) AS sizes(size))
        GROUP BY ALL
    ), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
    candidates AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE size > 1 AND f >= 30),
    held AS (
        SELECT lang, array_to_string(w[i : i + inner_size - 1], ' ') AS phrase, max(a) AS longer
        FROM (SELECT lang, w, a, inner_size, unnest(range(1, size - inner_size + 2)) AS i
              FROM candidates, range(2, 4) AS sizes(inner_size) WHERE inner_size < size)
        GROUP BY ALL
    ), kept AS (
        SELECT c.* FROM candidates AS c LEFT JOIN held USING (lang, phrase)
        WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
    ), cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail
        FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
    ), scored AS (
        SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, k, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
        FROM cuts AS c JOIN counts AS x ON x.lang = c.lang AND x.phrase = head JOIN counts AS y ON y.lang = c.lang AND y.phrase = tail
        QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM scored JOIN totals USING (lang) QUALIFY rank <= 2000
"""

SQL = {
    "op1_near_vectors": _NEAR_VECTORS,
    "op6_mix_sources": _MIX,
    "op7_near_text": _NEAR_TEXT,
    "op8_license_diagonals": _licenses(),
    "op9_repeated_windows": _REPEATS,
    "op10_secret_ledger": _secrets(),
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_collocations": _COLLOCATIONS,
}
