"""DuckDB SQL for the queries of this subpackage that SQL expresses.

The others (trained models, hashes that DuckDB lacks, tokenizers, connected
components) are tested against brute force.
"""

from __future__ import annotations

from math import ceil

from daypulse.llm import license_scan as lic
from daypulse.llm import url_filter as urls

_LOW = f"'{urls.UPPER}', '{urls.LOWER}'"


def _url_model() -> str:
    rules = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))

    def case(value):
        return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(v, h, p)}'"
                                  for v, h, p in rules) + " END"

    orders = [f"""p0 AS (SELECT g, CASE WHEN x.na + x.ta > 0 THEN (s.na + x.ta * {1 / urls.SYMBOLS}::DOUBLE) / (x.na + x.ta) ELSE {1 / urls.SYMBOLS}::DOUBLE END AS pa,
      CASE WHEN x.nr + x.tr > 0 THEN (s.nr + x.tr * {1 / urls.SYMBOLS}::DOUBLE) / (x.nr + x.tr) ELSE {1 / urls.SYMBOLS}::DOUBLE END AS pr
      FROM seen s JOIN ctx x ON x.x = '' WHERE length(g) = 1)"""]
    for k in range(1, urls.ORDER + 1):
        orders.append(f"""p{k} AS (SELECT s.g, CASE WHEN x.na + x.ta > 0 THEN (s.na + x.ta * q.pa) / (x.na + x.ta) ELSE q.pa END AS pa,
      CASE WHEN x.nr + x.tr > 0 THEN (s.nr + x.tr * q.pr) / (x.nr + x.tr) ELSE q.pr END AS pr
      FROM seen s JOIN ctx x ON x.x = substr(s.g, 1, length(s.g) - 1) JOIN p{k - 1} q ON q.g = substr(s.g, 2)
      WHERE length(s.g) = {k + 1})""")
    n = urls.ORDER + 1
    joins = " ".join(f"""LEFT JOIN w w{k} ON length(b.g) >= {k} AND w{k}.g = right(b.g, {k})
      LEFT JOIN esc e{k} ON length(b.g) >= {k} AND length(e{k}.x) = {k - 1} AND e{k}.x = substr(b.g, length(b.g) - {k - 1}, {k - 1})"""
                     for k in range(1, n + 1))
    total = "0"
    for k in range(1, n + 1):
        total = f"coalesce(w{k}.w, coalesce(e{k}.e, 0) + {total})"

    def escape(s):
        return f"CASE WHEN n{s} + t{s} > 0 THEN ln(t{s} / (n{s} + t{s})) ELSE 0 END"

    return f"""
    WITH cut AS (SELECT url, count(*) AS n, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
      FROM pages WHERE url IS NOT NULL GROUP BY url),
    hp AS (SELECT url, n, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOW}) AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    u AS (SELECT *, {case(lambda v, h, p: v)} AS label, {case(lambda v, h, p: h + p)} AS rule,
      '^' || regexp_replace(translate(url, '{urls.UPPER}123456789', '{urls.LOWER}000000000'), '[^a-z0/._?=&#:%-]', '*', 'g') || '$' AS t,
      substr(md5(url), 1, 1) IN ('0', '1', '2') AS fold FROM hp),
    pos AS (SELECT url, label, n, fold, t, unnest(range(2, length(t) + 1)) AS i FROM u),
    b AS (SELECT url, label, n, fold, substr(t, greatest(1, i - {urls.ORDER}), least(i, {n})) AS g FROM pos),
    gr AS (SELECT label, n, right(g, k::INT) AS g FROM (SELECT *, unnest(range(1, length(g) + 1)) AS k FROM b WHERE label IS NOT NULL AND NOT fold)),
    seen AS (SELECT g, coalesce(sum(n) FILTER (label = 'allow'), 0)::DOUBLE AS na, coalesce(sum(n) FILTER (label = 'block'), 0)::DOUBLE AS nr
      FROM gr GROUP BY g),
    ctx AS (SELECT substr(g, 1, length(g) - 1) AS x, sum(na) AS na, sum(nr) AS nr, (count(*) FILTER (na > 0))::DOUBLE AS ta,
      (count(*) FILTER (nr > 0))::DOUBLE AS tr FROM seen GROUP BY 1),
    {', '.join(orders)},
    w AS (SELECT g, round((ln(pa) - ln(pr)) * 1e6)::BIGINT AS w FROM ({' UNION ALL '.join(f'SELECT * FROM p{k}' for k in range(n))})),
    esc AS (SELECT x, round(({escape('a')} - {escape('r')}) * 1e6)::BIGINT AS e FROM ctx),
    sc AS (SELECT b.url, floor(sum({total})::DOUBLE / count(*))::BIGINT AS score FROM b {joins} GROUP BY b.url),
    su AS (SELECT u.*, sc.score FROM u JOIN sc USING (url)),
    bins AS (SELECT greatest(-{urls.STEPS}, least({urls.STEPS}, floor(score / {float(urls.STEP)})))::BIGINT AS b,
      coalesce(sum(n) FILTER (label = 'allow'), 0) AS na, coalesce(sum(n) FILTER (label = 'block'), 0) AS nr
      FROM su WHERE fold AND label IS NOT NULL GROUP BY 1),
    tried AS (SELECT c.b, (SELECT max(b) FROM bins WHERE b < c.b) AS last,
      (SELECT coalesce(sum(na), 0) FROM bins WHERE b < c.b) * (SELECT sum(nr) FROM bins)
      + (SELECT sum(nr) FROM bins WHERE b >= c.b) * (SELECT sum(na) FROM bins) AS cost FROM bins c),
    best AS (SELECT floor((coalesce(last + 1, b) + b) / 2.0) * {urls.STEP} AS v FROM tried
      WHERE (SELECT sum(na) > 0 AND sum(nr) > 0 FROM bins) ORDER BY cost, b LIMIT 1),
    known AS (SELECT count(DISTINCT label) = 2 AS both_seen FROM u WHERE label IS NOT NULL AND NOT fold),
    lim AS (SELECT both_seen, CASE WHEN both_seen THEN coalesce((SELECT v FROM best), 0) ELSE 0 END AS v FROM known)
    SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
      coalesce(label, CASE WHEN CASE WHEN both_seen THEN score ELSE 0 END < v THEN 'block' ELSE 'allow' END) AS verdict,
      CASE WHEN both_seen THEN score WHEN score IS NOT NULL THEN 0 END AS score
    FROM pages LEFT JOIN su USING (url), lim"""


_HAMMING = """
    WITH q AS (SELECT vec_id AS query_id, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0 AND embedding IS NOT NULL),
    d AS (SELECT DISTINCT query_id, vec_id AS neighbour_id, list_sum(list_transform(range(1, 65),
        lambda i: CASE WHEN (coalesce(qe[i], 0) > 0 AND NOT isnan(coalesce(qe[i], 0)))
                        <> (coalesce(embedding[i], 0) > 0 AND NOT isnan(coalesce(embedding[i], 0))) THEN 1 ELSE 0 END))::INT AS distance
      FROM q, embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)
    SELECT query_id, rank::INT AS rank, neighbour_id, distance FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM d) WHERE rank <= 10"""


def _licenses() -> str:
    sets = [(label, sorted(set(t.split()))) for label, t in lic.TEMPLATES]
    templates = ", ".join(f"('{label}', {s}, {ceil(lic.THRESHOLD * len(s) - 1e-9)})" for label, s in sets)

    def places(phrase):
        parts = phrase.split()
        return f"list_filter(range(0, len(w)), lambda i: w[i + 1:i + {len(parts)}] = {parts})"

    phrases = sorted(lic.PHRASES.items())
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    t(label, words, need) AS (VALUES {templates}),
    ws AS (SELECT r, doc_id, regexp_extract_all(translate(text, {_LOW}), '{lic.WORD}') AS w FROM d),
    p AS (SELECT r, doc_id, len(w) AS n_words, {', '.join(f'{places(ph)} AS p{i}' for i, (_, ph) in enumerate(phrases))} FROM ws),
    bl AS (SELECT r, false AS over, unnest(regexp_split_to_array(regexp_replace(text, '([.!?])[ \\t\\r\\n]+', '\\1\n', 'g'), '[\\r\\n]+')) AS b
      FROM d UNION ALL SELECT r, true, unnest(regexp_split_to_array(regexp_replace(replace(replace(text, '\r\n', '\n'), '\r', '\n'),
        '([.!?])[ \\t\\n]+', '\\1\n\n', 'g'), '\n[^\\n0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]*\n')) FROM d),
    bw AS (SELECT r, over, regexp_extract_all(translate(b, {_LOW}), '{lic.WORD}') AS w FROM bl),
    m0 AS (SELECT r, over, w, label, words, len(list_intersect(list_distinct(w), words)) AS n, need, len(words) AS size FROM bw, t),
    m AS (SELECT * FROM m0 WHERE n >= need AND CASE WHEN over AND n >= need THEN
      len(list_filter(range(1, len(w) + 1), lambda i: len(list_intersect(list_distinct(w[i:i + {lic.SPREAD} * size - 1]), words)) >= need)) > 0
      ELSE true END),
    f AS (SELECT r, list(DISTINCT label) AS more, max(n / size::DOUBLE) AS best FROM m WHERE n >= need GROUP BY r),
    a AS (SELECT p.*, more, best, list_concat({', '.join(f'p{i}' for i in range(len(phrases)))}) AS spots,
      list_filter([{', '.join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END" for i, (label, _) in enumerate(phrases))}], lambda x: x IS NOT NULL) AS mine
      FROM p LEFT JOIN f USING (r))
    SELECT doc_id, n_words, len(spots) AS n_base, list_min(spots) AS first_word, list_max(spots) AS last_word,
      coalesce(array_to_string(list_sort(mine), ','), '') AS base_labels,
      coalesce(array_to_string(list_sort(list_distinct(list_concat(mine, coalesce(more, [])))), ','), '') AS labels,
      CASE WHEN len(spots) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score FROM a"""


def _crc32(text: str) -> str:
    """CRC-32 of a short ASCII text, bit by bit (3988292384: the reflected polynomial)."""
    byte = "lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    over = f"list_reduce(list_prepend(xor(r, b), range(1, 9)), {byte})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda r, b: {over}), 4294967295)"


_PAIR = "(VALUES (0, 2), (1, 2), (2, 3), (3, 2)) AS {0}(s, t)"

#: The least (cost, audit) to the end from each row and state, from the last row back; then the edits are applied.
_REPAIR = f"""
    WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations),
    d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
      CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END))
      FROM raw WHERE k <> 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text)) AS i,
      count(*) OVER (PARTITION BY conv_id) AS n FROM d),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM ranked),
    f AS MATERIALIZED (SELECT conv_id, turn, role, text, i, n, left(role, 1) AS c,
      CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
    ins AS (SELECT s, s AS t, 0 AS cost, '' AS letters FROM {_PAIR.format('p')}
      UNION ALL SELECT s, t, 2, 'I' FROM {_PAIR.format('p')}
      UNION ALL SELECT p.s, q.t, 4, 'II' FROM {_PAIR.format('p')} JOIN {_PAIR.format('q')} ON q.s = p.t),
    edit AS (SELECT s, s AS t, '' AS c, 3 AS cost, 'D' AS letter FROM {_PAIR.format('p')}
      UNION ALL SELECT s, t, '', 2, 'R' FROM {_PAIR.format('p')}
      UNION ALL SELECT * FROM (VALUES (0, 1, 's', 0, 'K'), (0, 2, 'u', 0, 'K'), (1, 2, 'u', 0, 'K'), (3, 2, 'u', 0, 'K'), (2, 3, 'a', 0, 'K'))),
    step AS MATERIALIZED (SELECT ins.s, edit.t, edit.c, ins.cost + edit.cost AS cost, ins.letters || edit.letter AS letters, edit.letter
      FROM ins JOIN edit ON edit.s = ins.t),
    w AS (SELECT DISTINCT conv_id, n + 1 AS i, e.s, {{'cost': e.cost, 'audit': e.audit}} AS best
      FROM f, (VALUES (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')) AS e(s, cost, audit)
      UNION ALL SELECT f.conv_id, f.i, step.s, min({{'cost': w.best.cost + step.cost + CASE WHEN fault = 'truncated' AND step.letter <> 'D' THEN 1 ELSE 0 END,
        'audit': step.letters || w.best.audit}})
      FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i - 1
      JOIN step ON step.t = w.s AND (step.c = '' OR step.c = f.c) AND (step.letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
      GROUP BY f.conv_id, f.i, step.s),
    cheapest AS (SELECT conv_id, best.cost AS cost, best.audit AS audit FROM w WHERE i = 1 AND s = 0),
    letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS pos FROM cheapest WHERE audit <> ''),
    placed AS (SELECT *, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS i FROM letters),
    left_rows AS (SELECT p.conv_id, p.pos, p.letter, f.role, f.text, row_number() OVER (PARTITION BY p.conv_id ORDER BY p.pos) AS q
      FROM placed p LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i AND p.letter <> 'I' WHERE p.letter <> 'D'),
    begun AS (SELECT *, max(CASE WHEN q = 1 AND letter = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM left_rows),
    done AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (q - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
      || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos)) AS sha FROM begun GROUP BY conv_id),
    pairs AS (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair FROM f),
    counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
      count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY conv_id)
    SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
      coalesce(sha, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN cheapest ON cheapest.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM c.conv_id"""


_NEGATIVES = """
    WITH v AS (SELECT row_number() OVER () AS r, * FROM (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
    s AS (SELECT a.r, a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, coalesce(list_sum(list_transform(
        range(1, least(len(a.x), len(b.x)) + 1), lambda i: a.x[i] * b.x[i])), 0)::BIGINT AS score FROM v a, v b WHERE a.id % 50 = 0 AND a.id <> b.id),
    p AS (SELECT r, anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) <= 5),
    n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.r, positive_id ORDER BY s.score DESC, s.other_id)::INT AS rank
      FROM p JOIN s ON s.r = p.r AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def oracle_sql() -> dict[str, str]:
    return {"op3_url_language_model": _url_model(), "op4_multi_index_hashing": _HAMMING, "op7_license_scan": _licenses(),
            "op12_conversation_repair": _REPAIR, "op13_hard_negatives": _NEGATIVES}
