"""DuckDB SQL for the operators that SQL can express: the same answers by plain joins and grouping."""

from __future__ import annotations

from billow.llm import quality_rules as q
from billow.llm import spot_signatures as g

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text=f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM d),
e AS MATERIALIZED (SELECT doc_id, unnest(g) AS g FROM s),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.y), n.doc_id)) AS component_id
FROM n LEFT JOIN reach r ON r.x = n.doc_id GROUP BY n.doc_id, n.n"""


def quality_rules() -> str:
    """Base counts by lists and windows, then the concentration steps as one CTE each."""
    f, p = list(q.FEATURES), q.P
    sums = ", ".join(["CAST(count(*) AS DOUBLE) AS s", *[f"sum({f[i]}) AS s{i}" for i in range(p)],
                      *[f"sum({f[i]} * {f[j]}) AS s{i}{j}" for i in range(p) for j in range(i, p)]])
    ctes = [
        f"d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents)",
        r"y AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d)",
        "g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) > 4)",
        "h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS c FROM g)",
        "k AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM h, range(5) AS o(k) WHERE c > 1 GROUP BY doc_id)",
        r"""b AS (SELECT y.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS n_upper,
            len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(k.n, 0) AS BIGINT) AS n_repeat_words
            FROM y LEFT JOIN k ON k.doc_id = y.doc_id)""",
        f"c AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed, "
        f"ln((word_chars + {5.0 * q.PRIOR_WORDS}) / (n_words + {q.PRIOR_WORDS})) AS f_len, sqrt(n_symbols / (word_chars + {5.0 * q.PRIOR_WORDS})) AS f_symbols, "
        f"sqrt(n_upper / (word_chars + {5.0 * q.PRIOR_WORDS})) AS f_upper, n_dup_lines / (n_lines + 10.0::DOUBLE) AS f_lines, "
        f"n_repeat_words / (n_words + {float(q.PRIOR_WORDS)}::DOUBLE) AS f_repeat FROM b)",
        "a AS (SELECT c.*, coalesce(lang, '-') AS lng, coalesce(lang, '-') || '|' || coalesce(source, '-') AS grp FROM c)",
        "fit AS (SELECT * FROM a WHERE NOT base_failed)",
        f"med AS (SELECT grp, {', '.join(f'quantile_disc({x}, 0.5) AS c_{x}' for x in f)} FROM fit GROUP BY grp)",
        f"near0 AS (SELECT fit.*, {' + '.join(f'pow(({x} - c_{x}) / {v!r}, 2)' for x, v in q.FEATURES.items())} AS d2 FROM fit JOIN med USING (grp))",
    ]

    def distance(source: str, fits: str, name: str) -> list[str]:
        out, last = [], fits
        for i in range(p):
            for j in range(i + 1):
                less = "".join(f" - l{i}{x} * l{j}{x}" for x in range(j))
                entry = f"{q.covariance(i, j)}{less}"
                value = f"sqrt(greatest({entry}, 1e-12))" if i == j else f"({entry}) / l{j}{j}"
                out.append(f"{name}_l{i}{j} AS (SELECT *, {value} AS l{i}{j} FROM {last})")
                last = f"{name}_l{i}{j}"
        fitted = ", ".join(["grp AS fg", *[f"s{i} / s AS m{i}" for i in range(p)], *[f"l{i}{j}" for i in range(p) for j in range(i + 1)]])
        out.append(f"{name}_z AS (SELECT {source}.*, t.* FROM {source} LEFT JOIN (SELECT {fitted} FROM {last}) t ON fg = grp)")
        last = f"{name}_z"
        for i in range(p):
            less = "".join(f" - l{i}{x} * z{x}" for x in range(i))
            out.append(f"{name}_z{i} AS (SELECT *, ({f[i]} - m{i}{less}) / l{i}{i} AS z{i} FROM {last})")
            last = f"{name}_z{i}"
        out.append(f"{name} AS (SELECT *, {' + '.join(f'z{i} * z{i}' for i in range(p))} AS d2 FROM {last})")
        return out

    for step in range(q.STEPS + 1):
        if step:
            ctes += distance("fit", f"sums{step - 1}", f"near{step}")
        ctes += [
            f"bin{step} AS (SELECT *, floor(log2(greatest(d2, 1e-9)) * {q.BINS}) AS bin FROM near{step})",
            f"cum{step} AS (SELECT grp, bin, sum(count(*)) OVER (PARTITION BY grp ORDER BY bin) AS c, sum(count(*)) OVER (PARTITION BY grp) AS n FROM bin{step} GROUP BY grp, bin)",
            f"cut{step} AS (SELECT grp, min(bin) AS cut FROM cum{step} WHERE c >= n * {q.H_SHARE} GROUP BY grp)",
            f"own{step} AS (SELECT grp, lng, {sums} FROM bin{step} JOIN cut{step} USING (grp) WHERE bin <= cut GROUP BY grp, lng)",
            f"lang{step} AS (SELECT lng, {', '.join(f'sum({m}) AS l_{m}' for m in q.MOMENTS)} FROM own{step} GROUP BY lng)",
            f"corpus{step} AS (SELECT {', '.join(f'sum({m}) AS c_{m}' for m in q.MOMENTS)} FROM own{step})",
            f"lean{step} AS (SELECT lng, {', '.join(f'(l_{m} + {q.PRIOR_ROWS} * c_{m} / c_s) / (l_s + {q.PRIOR_ROWS}) AS p_{m}' for m in q.MOMENTS)} FROM lang{step}, corpus{step})",
            f"sums{step} AS (SELECT grp, {', '.join(f'{m} + {q.PRIOR_ROWS} * p_{m} AS {m}' for m in q.MOMENTS)} FROM own{step} JOIN lean{step} USING (lng))",
        ]
    ctes += distance("a", f"sums{q.STEPS}", "judged")
    return "WITH " + ",\n".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(d2 > {q.CUTOFF}, false) AS kept FROM judged"""


HARD_NEGATIVES = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.w, b.w) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

#: crc32 by its table of 256 remainders, over the UTF-8 bytes of id, colon and run.
SPELLING = f"""
WITH RECURSIVE d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]{{7,}}')) AS run FROM documents),
e AS (SELECT doc_id, run, count(*) AS n FROM d GROUP BY ALL),
t AS MATERIALIZED (SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS r
    FROM range(256) x(i)),
b AS (SELECT doc_id, run, n, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes FROM e),
h AS (SELECT run, n, xor(4294967295, list_reduce(bytes, lambda c, x: xor(c >> 8, r[1 + (xor(c, CAST(x AS BIGINT)) & 255)]), 4294967295::BIGINT)) AS h FROM b, t),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 31 = 0
        THEN concat(run[:h % len(run)], run[h % len(run) + 2:]) ELSE run END AS word FROM h) WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS MATERIALIZED (SELECT word, i, concat(word[:i], word[i + 2:]) AS rest FROM (SELECT word, unnest(range(len(word))) AS i FROM w)),
near AS MATERIALIZED (SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT cut.word, w.word FROM cut JOIN w ON w.word = rest UNION SELECT w.word, cut.word FROM cut JOIN w ON w.word = rest),
best AS (SELECT x, count(*) AS n_near, arg_min(y, {{'a': -w.n, 'b': y}}) AS y FROM near JOIN w ON w.word = y GROUP BY x),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN o.n >= 10 * w.n THEN y END AS form, CASE WHEN o.n >= 10 * w.n THEN o.n END AS form_n
    FROM w LEFT JOIN best ON x = w.word LEFT JOIN w o ON o.word = y),
walk AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.next)
SELECT f.word, f.form, walk.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL"""


def spot_signatures() -> str:
    """The chains by numbered words: content words, and before which of them common words stand."""
    common = ", ".join(f"'{c}'" for c in dict.fromkeys(g.COMMON))

    def signed(name: str, source: str, text: str) -> list[str]:
        return [
            rf"{name}_w AS (SELECT k, t, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM (SELECT doc_id AS k, {text} AS t FROM {source}))",
            f"{name}_u AS (SELECT k, unnest(w) AS x, unnest(range(len(w))) AS i FROM {name}_w)",
            f"{name}_v AS (SELECT *, x NOT IN ({common}) AS content, coalesce(sum(CASE WHEN x NOT IN ({common}) THEN 1 END) "
            f"OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM {name}_u)",
            # the common words of a place stand before its content word; the last place may hold none
            f"{name}_p AS (SELECT k, place, coalesce(list(x ORDER BY i) FILTER (NOT content), []) AS anchor, coalesce(any_value(x) FILTER (content), '') AS word FROM {name}_v GROUP BY ALL)",
            f"{name}_c AS (SELECT *, " + ", ".join(f"lead(word, {i}) OVER o AS w{i}" for i in range(1, g.CHAIN)) + f" FROM {name}_p WINDOW o AS (PARTITION BY k ORDER BY place))",
            f"{name}_s AS (SELECT k, list_sort(list(DISTINCT left(md5(concat_ws(' ', concat(CASE WHEN place = 0 THEN chr(1) ELSE '' END, "
            f"CASE WHEN len(anchor) > 0 THEN concat(array_to_string(anchor, chr(1)), chr(1)) ELSE '' END, word), "
            + ", ".join(f"w{i}" for i in range(1, g.CHAIN)) + f")), {g.DIGITS}))) AS s FROM {name}_c WHERE place = 0 OR len(anchor) > 0 GROUP BY k)",
            f"{name} AS (SELECT {name}_w.k, t, CASE WHEN t = '' THEN [] WHEN len(w) = 0 THEN [left(md5(t), {g.DIGITS})] ELSE s END AS s "
            f"FROM {name}_w LEFT JOIN {name}_s ON {name}_s.k = {name}_w.k)"]

    ctes = ["d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)", *signed("own", "d", "text"),
            "f AS (SELECT doc_id, text, coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next FROM d WINDOW o AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))",
            "x AS (SELECT f.doc_id, next, length(f.text) AS n, concat(left(f.text, CAST(n - n // 3 AS BIGINT)), left(z.text, CAST(n // 3 AS BIGINT))) AS edited FROM f JOIN d z ON z.doc_id = next)",
            *signed("edit", "x", "edited")]

    def like(a: str, b: str) -> str:
        return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE len(list_intersect({a}, {b})) / CAST(len({a}) + len({b}) - len(list_intersect({a}, {b})) AS DOUBLE) END"

    return "WITH " + ",\n".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes) + f"""
SELECT x.doc_id, CAST(x.n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(own.s, '') AS fingerprint,
    array_to_string(edit.s, '') AS edited_fingerprint, {like('own.s', 'edit.s')} AS near_edited, {like('own.s', 'other.s')} AS near_next
FROM x JOIN own ON own.k = x.doc_id JOIN edit ON edit.k = x.doc_id JOIN own other ON other.k = x.next"""


ORACLE = {"op11_spot_signatures": spot_signatures(), "op12_spelling_groups": SPELLING, "op13_hard_negatives": HARD_NEGATIVES,
          "op5_quality_rules": quality_rules(), "op7_ngram_jaccard_join": NGRAM_JOIN}
