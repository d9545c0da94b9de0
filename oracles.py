"""DuckDB SQL that states what each query must return."""

from __future__ import annotations

# Fixed values, written out here again so that the SQL shares none with the code it checks.
# Porter's suffix rules with the common extensions:
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
RESTORED = [("at", "ate"), ("bl", "ble"), ("iz", "ize")]
DOUBLE_SUFFIXES = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
]
ADJECTIVES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
]
ENDINGS = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]
# Endings of plural nouns and of their singulars:
NOUN_ENDINGS = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]
# Tokens dropped after segmentation, the modulus of the draws, hits per query:
STOP_TOKENS = ["的", "了", "和", "与", "或", "一个", "一种", "这个", "那个"]
PRIME = 2147483647
K = 5
# The logistic model of the checked queries: weights of f1 to f7, and intercept.
WEIGHTS, INTERCEPT = [3.0, 6.0, 2.0, 1.0, 1.0, 5.0, 1.0], -9.0
# Characters outside what a cleaned meaning keeps:
KEPT = "[^一-龥a-zA-Z0-9，,。？?！!；;]"


def words_of(table: str, text: str) -> str:
    return (
        f"SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(lower({text}), "
        f"'[a-z]+')) AS word FROM {table}) GROUP BY word"
    )


# --- stems: vowel patterns by regular expressions, one table per step ---------------


def _classes(word: str) -> str:
    out = f"regexp_replace(regexp_replace({word}, '[aeiou]', 'V', 'g'), '[b-df-hj-np-tv-xz]', 'C', 'g')"
    out = f"regexp_replace({out}, '^y', 'C')"
    for _ in range(4):
        out = f"replace(replace({out}, 'Cy', 'CV'), 'Vy', 'VC')"
    return out


def _cut(col: str, n: int) -> str:
    return f"left({col}, length({col}) - {n})" if n else col


def _measure(classes: str) -> str:
    return f"len(regexp_extract_all({classes}, 'VC'))"


def _short(word: str, classes: str) -> str:
    return f"({classes} = 'VC' OR (ends_with({classes}, 'CVC') AND right({word}, 1) NOT IN ('w','x','y')))"


def _first_suffix(rules, test) -> str:
    whens = " ".join(
        f"WHEN ends_with(w, '{old}') THEN CASE WHEN {test(old)} "
        f"THEN concat({_cut('w', len(old))}, '{new}') ELSE w END"
        for old, new in rules
    )
    return f"CASE {whens} ELSE w END"


def stems_of(source: str, name: str) -> str:
    """CTEs that end in ``name(word, stem)`` for the distinct words of ``source``."""

    def step(i: int, expr: str) -> str:
        return (
            f"{name}_s{i} AS (SELECT word, w, {_classes('w')} AS c FROM "
            f"(SELECT word, {expr} AS w FROM {name}_s{i - 1}))"
        )

    plural = f"CASE WHEN length(w) = 4 AND ends_with(w, 'ies') THEN left(w, 3) ELSE {_first_suffix(PLURALS, lambda s: 'true')} END"
    rest = (
        "CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL "
        f"WHEN ends_with(w, 'ed') AND contains({_cut('c', 2)}, 'V') THEN {_cut('w', 2)} "
        f"WHEN ends_with(w, 'ing') AND contains({_cut('c', 3)}, 'V') THEN {_cut('w', 3)} END"
    )
    restored = " ".join(
        f"WHEN ends_with(r, '{a}') THEN concat({_cut('r', len(a))}, '{b}')" for a, b in RESTORED
    )
    past = (
        "CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN left(w, 3) "
        f"ELSE {_cut('w', 2)} END "
        f"WHEN ends_with(w, 'eed') THEN CASE WHEN {_measure(_cut('c', 3))} > 0 THEN {_cut('w', 1)} ELSE w END "
        f"WHEN r IS NULL THEN w {restored} "
        "WHEN length(r) > 1 AND right(r, 1) = left(right(r, 2), 1) AND right(rc, 1) = 'C' "
        f"THEN CASE WHEN right(r, 1) IN ('l','s','z') THEN r ELSE {_cut('r', 1)} END "
        f"WHEN {_measure('rc')} = 1 AND {_short('r', 'rc')} THEN concat(r, 'e') ELSE r END"
    )
    final_y = (
        f"CASE WHEN length(w) > 2 AND ends_with(w, 'y') AND right({_cut('c', 1)}, 1) = 'C' "
        f"THEN concat({_cut('w', 1)}, 'i') ELSE w END"
    )

    def double_test(s: str) -> str:
        return f"{_measure(_cut('c', 3 if s == 'logi' else len(s)))} > 0"

    double = (
        f"CASE WHEN ends_with(w, 'alli') AND {_measure(_cut('c', 4))} > 0 THEN {_cut('w', 2)} "
        f"ELSE {_first_suffix(DOUBLE_SUFFIXES, double_test)} END"
    )
    adjective = _first_suffix(ADJECTIVES, lambda s: f"{_measure(_cut('c', len(s)))} > 0")

    def ending_test(s: str) -> str:
        tail = f" AND right({_cut('w', 3)}, 1) IN ('s','t')" if s == "ion" else ""
        return f"{_measure(_cut('c', len(s)))} > 1{tail}"

    ending = _first_suffix([(e, "") for e in ENDINGS], ending_test)
    m = _measure(_cut("c", 1))
    last_e = (
        f"CASE WHEN ends_with(w, 'e') AND ({m} > 1 OR ({m} = 1 AND NOT "
        f"{_short(_cut('w', 1), _cut('c', 1))})) THEN {_cut('w', 1)} ELSE w END"
    )
    double_l = f"CASE WHEN ends_with(w, 'll') AND {m} > 1 THEN {_cut('w', 1)} ELSE w END"
    odd = " ".join(f"WHEN word = '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    return ", ".join(
        [
            f"{name}_s0 AS (SELECT word, word AS w, {_classes('word')} AS c FROM (SELECT DISTINCT word FROM {source}))",
            step(1, plural),
            f"{name}_r AS (SELECT word, w, c, r, {_classes('r')} AS rc FROM (SELECT *, {rest} AS r FROM {name}_s1))",
            f"{name}_s2 AS (SELECT word, w, {_classes('w')} AS c FROM (SELECT word, {past} AS w FROM {name}_r))",
            step(3, final_y),
            step(4, double),
            step(5, adjective),
            step(6, ending),
            step(7, last_e),
            step(8, double_l),
            f"{name} AS (SELECT word, CASE {odd} WHEN length(word) <= 2 THEN word ELSE w END AS stem FROM {name}_s8)",
        ]
    )


# --- word tables with what the pair expressions need --------------------------------


def vocabulary(name: str, table: str, text: str) -> str:
    """CTEs ending in ``name(idx, word, meaning, stem, len, mask, grams)``."""
    return (
        f"{name}_w AS ({words_of(table, text)}), {stems_of(f'{name}_w', f'{name}_stem')}, "
        f"{name} AS ({_signed(f'SELECT row_number() OVER (ORDER BY word) - 1 AS idx, word, CAST(freq AS VARCHAR) AS meaning, stem FROM {name}_w JOIN {name}_stem USING (word)')})"
    )


def _signed(source: str) -> str:
    return (
        "SELECT *, length(word) AS len, "
        "coalesce(list_sum(list_transform(list_distinct(list_filter(string_split(word, ''), "
        "lambda c: c <> '')), lambda c: 1::BIGINT << (ascii(c) - 97))), 0)::BIGINT AS mask, "
        "list_distinct(list_transform(range(1, len(word)), lambda i: substr(word, i, 2))) AS grams "
        f"FROM ({source})"
    )


F1 = "coalesce(bit_count(a.mask & b.mask)::DOUBLE / nullif(bit_count(a.mask | b.mask), 0), 0)"
TOP = "greatest(a.len, b.len)"
SAME = (
    "len(list_filter(range(1, least(a.len, b.len) + 1), "
    "lambda i: substr(a.word, i, 1) = substr(b.word, i, 1)))"
)
F2 = f"coalesce({SAME}::DOUBLE / nullif({TOP}, 0), 0)"
SHARED = "len(list_intersect(a.grams, b.grams))"
F3 = (
    "CASE WHEN len(a.grams) = 0 OR len(b.grams) = 0 THEN 0 ELSE "
    f"{SHARED}::DOUBLE / (len(a.grams) + len(b.grams) - {SHARED}) END"
)
F4 = "CAST(a.stem = b.stem AS DOUBLE)"
F5 = f"1 - coalesce(abs(a.len - b.len)::DOUBLE / nullif({TOP}, 0), 0)"
F6 = f"1 - coalesce(levenshtein(a.word, b.word)::DOUBLE / nullif({TOP}, 0), 1)"
GAPS = (
    "list_filter(list_transform(range(1, a.len + 1), lambda i: CASE WHEN "
    "instr(b.word, substr(a.word, i, 1)) > 0 THEN abs(i - instr(b.word, substr(a.word, i, 1))) END), "
    "lambda g: g IS NOT NULL)"
)
F7 = f"1 - coalesce(list_sum({GAPS})::DOUBLE / nullif(len({GAPS}), 0) / {TOP}, 1)"
LCS = (
    "CASE WHEN a.word = '' OR b.word = '' THEN 0 ELSE list_extract(list_reduce("
    "list_transform(string_split(a.word, ''), lambda x: [ascii(x)::BIGINT]), lambda p, x: "
    "list_reduce(list_transform(range(1, b.len + 1), lambda j: [j]), lambda cur, j: "
    "list_append(cur, CASE WHEN x[1] = ascii(substr(b.word, j[1], 1)) THEN p[j[1]] + 1 "
    "ELSE greatest(p[j[1] + 1], cur[j[1]]) END), [0::BIGINT]), "
    "list_transform(range(0, b.len + 1), lambda z: 0::BIGINT)), -1) END"
)
LCS_RATIO = f"coalesce(2 * ({LCS})::DOUBLE / nullif(a.len + b.len, 0), 1)"
ALL = {"f1": F1, "f2": F2, "f3": F3, "f4": F4, "f5": F5, "f6": F6, "f7": F7}
FEATURE_COLUMNS = ", ".join(f"{e} AS {n}" for n, e in ALL.items())
ROUNDED = ", ".join(f"round({n}, 6) AS {n}" for n in ALL)

_Z = " + ".join([str(INTERCEPT), *[f"{w} * f{i + 1}" for i, w in enumerate(WEIGHTS)]])
PROB = f"1.0 / (1.0 + exp(-({_Z})))"


def _score(prob: str = "ml_prob", f2: str = "f2") -> str:
    rule = f"(({f2} + f6) / 2)"
    return (
        f"0.4 * {rule} + 0.6 * CASE WHEN {prob} > 0.5 AND {rule} < 0.4 "
        f"THEN {prob} * 0.2 ELSE {prob} END"
    )


BENCH = vocabulary("v", "benchmark", "text")
NEXT = "v a JOIN v b ON b.idx BETWEEN a.idx + 1 AND a.idx + 49"
BAND = "a.word <> b.word AND b.len BETWEEN a.len - 3 AND a.len + 3"


def _hits(asked: str, known: str, f2: str = F2) -> str:
    """CTEs ending in ``top(qid, asked, rank, idx, hit, meaning, score)``."""
    columns = FEATURE_COLUMNS.replace(f"{F2} AS f2", f"{f2} AS f2")
    return (
        "near AS (SELECT a.idx AS qid, b.idx AS hit_idx FROM "
        f"{asked} a JOIN {known} b ON {BAND} WHERE {F1} >= 0.3 AND {F6} >= 0.25), "
        f"feat AS (SELECT a.idx AS qid, a.word AS asked, b.idx, b.word AS hit, b.meaning, b.len, {columns} "
        f"FROM near JOIN {asked} a ON a.idx = qid JOIN {known} b ON b.idx = hit_idx), "
        f"prob AS (SELECT *, {PROB} AS ml_prob FROM feat), "
        f"scored AS (SELECT *, {_score()} AS score FROM prob), "
        "top AS (SELECT qid, asked, row_number() OVER (PARTITION BY qid ORDER BY score DESC, len, idx) "
        f"AS rank, idx, hit, meaning, score FROM scored WHERE score > 0.1 QUALIFY rank <= {K})"
    )


HIT_COLUMNS = "asked AS word, rank, hit, meaning, round(score, 6) AS score"

# --- vectors ------------------------------------------------------------------------

HEADWORD = (
    "coalesce(list_extract(list_sort(list_transform(regexp_extract_all(lower(text), '[a-z]+'), "
    "lambda w: {'n': -length(w), 'w': w})), 1).w, '')"
)
ROWS = (
    f"named AS (SELECT doc_id AS idx, {HEADWORD} AS word FROM documents), "
    "plain AS (SELECT coalesce(vec_id, idx) AS idx, coalesce(word, '') AS word, "
    "CASE WHEN vec_id IS NULL THEN '' ELSE concat('m', label) END AS meaning, "
    "CAST(embedding AS DOUBLE[]) AS vec FROM embeddings FULL JOIN named ON vec_id = idx)"
)


def _similarity(metric: str, a: str, b: str) -> str:
    if metric == "cosine":
        return f"list_cosine_similarity({a}, {b})"
    if metric == "euclidean":
        return f"1 / (1 + list_distance({a}, {b}))"
    gaps = f"list_transform(list_zip({a}, {b}), lambda p: abs(p[1] - p[2]))"
    return f"1 / (1 + list_sum({gaps}))"


def _near_vectors(metric: str) -> str:
    """CTEs ending in ``near_v(qid, rank, idx, word, meaning, score)``."""
    return (
        f"pair_v AS (SELECT a.idx AS qid, a.meaning AS asked, b.idx, b.word, b.meaning, "
        f"round({_similarity(metric, 'a.vec', 'b.vec')}, 10) AS score FROM plain a, plain b "
        "WHERE a.vec IS NOT NULL AND b.vec IS NOT NULL), "
        "cut_v AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, idx DESC) AS rank "
        f"FROM pair_v QUALIFY rank <= {K}), "
        "near_v AS (SELECT qid, rank, idx, word, meaning, score FROM cut_v WHERE rank = 1 OR meaning <> asked)"
    )


BOTH = (
    f"{ROWS}, {stems_of('plain', 'p_stem')}, "
    f"r AS ({_signed('SELECT idx, word, stem, meaning FROM plain JOIN p_stem USING (word)')}), "
    f"asked AS (SELECT * FROM r WHERE word <> ''), {_hits('asked', 'r')}, {_near_vectors('cosine')}"
)


def _lines(shape: str, semantic: str, columns: str) -> str:
    return (
        f"WITH {BOTH}, sh AS (SELECT qid, {shape} AS t FROM top GROUP BY qid), "
        f"se AS (SELECT qid, {semantic} AS t FROM near_v GROUP BY qid) "
        f"SELECT r.idx AS qid, {columns}coalesce(sh.t, '') AS shape, coalesce(se.t, '') AS semantic "
        "FROM r LEFT JOIN sh ON sh.qid = r.idx LEFT JOIN se ON se.qid = r.idx"
    )


# --- the draws of the negative pairs ------------------------------------------------


def _scrambled(number: str, salt: int) -> str:
    mixed = f"((({number}) % {PRIME}) * 48271 + {salt}) % {PRIME}"
    squared = f"(({mixed}) * ({mixed})) % {PRIME}"
    return f"(({squared}) * 16807 + {salt}) % {PRIME}"


POSITIVE = f"SELECT a.idx AS a_idx, b.idx AS b_idx, a.word AS a_word, b.word AS b_word, {F2} AS f2, {F6} AS f6 FROM {NEXT} WHERE abs(a.len - b.len) <= 3 AND f2 > 0.6 AND f6 > 0.5"
NEGATIVE = (
    f"pos AS ({POSITIVE}), n AS (SELECT count(*) AS n FROM v), "
    "goal AS (SELECT CAST(2 * count(*) AS BIGINT) AS goal FROM pos), "
    "ids AS (SELECT unnest(range(0, goal * 10)) AS draw, n FROM goal, n), "
    f"drawn AS (SELECT draw, n, {_scrambled('draw', 42)} % n AS i, ({_scrambled('draw', 42 + 7919)}) % (n - 1) + 1 AS step FROM ids), "
    "picked AS (SELECT draw, a.word AS a_word, b.word AS b_word, a.len AS la, b.len AS lb, "
    f"CASE WHEN abs(a.len - b.len) > 3 THEN 0 ELSE {LCS_RATIO} END AS ratio "
    "FROM drawn JOIN v a ON a.idx = i JOIN v b ON b.idx = (i + step) % n), "
    "neg AS (SELECT draw, a_word, b_word FROM picked WHERE abs(la - lb) > 3 OR ratio < 0.3 "
    "QUALIFY row_number() OVER (ORDER BY draw) <= (SELECT goal FROM goal))"
)

_stops = ", ".join(f"'{t}'" for t in STOP_TOKENS)
_pieces = f"regexp_extract_all(regexp_replace(text, '{KEPT}', '', 'g'), '[一-龥]+|[a-zA-Z0-9]+|[，,。？?！!；;]')"
_cut_pieces = (
    f"flatten(list_transform({_pieces}, lambda p: CASE WHEN regexp_full_match(p, '[一-龥]+') AND length(p) > 2 "
    "THEN list_transform(range(1, length(p)), lambda i: substr(p, i, 2)) ELSE [p] END))"
)
_endings = " UNION ALL ".join(
    f"SELECT word, depth + 1 AS depth, concat(left(form, length(form) - {len(old)}), '{new}') AS form "
    f"FROM edge WHERE ends_with(form, '{old}')"
    for old, new in NOUN_ENDINGS
)

ORACLES: dict[str, str] = {
    "clean_words": "SELECT raw, regexp_replace(lower(raw), '[^a-z]', '', 'g') AS word_clean FROM "
    "(SELECT DISTINCT unnest(string_split_regex(text, '[ \\t\\n\\r]+')) AS raw FROM documents)",
    "clean_meanings": f"SELECT doc_id, regexp_replace(text, '{KEPT}', '', 'g') AS meaning_clean FROM documents",
    "tokenize": "SELECT doc_id, CASE WHEN len(t) = 0 THEN '[]' ELSE concat('[''', "
    "array_to_string(t, ''', '''), ''']') END AS tokens FROM (SELECT doc_id, "
    f"list_filter({_cut_pieces}, lambda t: t NOT IN ({_stops})) AS t FROM documents)",
    "tokenize_lexicon": f"WITH RECURSIVE lex AS ({words_of('benchmark', 'text')}), "
    "tot AS (SELECT ln(sum(freq)) AS total, max(length(word)) AS longest FROM lex), "
    "doc AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z]+|[0-9]+|[，,。？?！!；;]') AS p FROM documents), "
    "cut AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS pos FROM doc), "
    "runs AS (SELECT DISTINCT piece FROM cut WHERE regexp_full_match(piece, '[a-z]+') AND length(piece) > 1), "
    "place AS (SELECT piece, unnest(range(1, length(piece) + 1)) AS spot FROM runs), "
    "part AS (SELECT piece, spot, unnest(range(1, least(longest, length(piece) - spot + 1) + 1)) AS size FROM place, tot), "
    "opts AS (SELECT piece, spot, list({'w': ln(freq) - total, 'size': size}) AS o FROM part "
    "JOIN lex ON word = substr(piece, spot, size), tot GROUP BY piece, spot), "
    "r AS (SELECT piece, length(piece) + 1 AS spot, [CAST(0 AS DOUBLE)] AS best, CAST([] AS BIGINT[]) AS steps FROM runs "
    "UNION ALL SELECT piece, spot, list_prepend(c.w, best), list_prepend(c.size, steps) FROM "
    "(SELECT r.piece, r.spot - 1 AS spot, best, steps, list_sort([{'w': x.w + best[x.size], 'size': x.size} "
    "FOR x IN coalesce(o, [{'w': -total, 'size': CAST(1 AS BIGINT)}])], 'DESC')[1] AS c "
    "FROM r CROSS JOIN tot LEFT JOIN opts ON opts.piece = r.piece AND opts.spot = r.spot - 1 WHERE r.spot > 1)), "
    "walk AS (SELECT piece, CAST(1 AS BIGINT) AS next, steps, CAST([] AS VARCHAR[]) AS t FROM r WHERE spot = 1 "
    "UNION ALL SELECT piece, next + steps[next], steps, list_append(t, substr(piece, next, steps[next])) FROM walk "
    "WHERE next <= length(piece)), "
    "best AS (SELECT piece, t FROM walk WHERE next > length(piece)) "
    "SELECT doc_id, coalesce(tokens, '') AS tokens FROM documents LEFT JOIN (SELECT doc_id, "
    "string_agg(coalesce(array_to_string(t, ' '), cut.piece), ' ' ORDER BY pos) AS tokens "
    "FROM cut LEFT JOIN best USING (piece) GROUP BY doc_id) USING (doc_id)",
    "word_index_vector": "SELECT word, array_to_string(list_transform(range(1, 21), lambda i: "
    "CASE WHEN substr(word, i, 1) = '' THEN 0 ELSE instr('abcdefghijklmnopqrstuvwxyz', substr(word, i, 1)) END), ',') "
    f"AS codes FROM ({words_of('documents', 'text')})",
    "stem": f"WITH w AS ({words_of('documents', 'text')}), {stems_of('w', 'st')} SELECT word, stem FROM st",
    "lemma": f"WITH RECURSIVE w AS ({words_of('documents', 'text')}), edge AS ("
    "SELECT word, 0 AS depth, word AS form FROM w UNION ALL "
    f"SELECT word, depth, form FROM ({_endings})), "
    "known AS (SELECT e.word, greatest(e.depth, 1) AS depth, e.form FROM edge e JOIN w ON w.word = e.form) "
    "SELECT word, list_extract(list_sort(list({'d': depth, 'n': length(form), 'f': form})), 1).f AS lemma "
    "FROM known GROUP BY word",
    "length_profile": "SELECT CAST(length(word) AS BIGINT) AS len, count(*) AS words FROM "
    f"({words_of('documents', 'text')}) GROUP BY 1",
    "shape_features": f"WITH {BENCH}, p AS (SELECT a.word AS a_word, b.word AS b_word, {FEATURE_COLUMNS} FROM {NEXT}) "
    f"SELECT a_word, b_word, {ROUNDED} FROM p",
    "shape_features_part_names": "WITH cut AS (SELECT string_split(p_name, ' ') AS s FROM part), "
    "names AS (SELECT DISTINCT unnest([[s[i], s[i + 1]] for i in range(1, len(s))]) AS w FROM cut), "
    f"a0 AS ({_signed('SELECT w AS id, w[1] AS word, w[1] AS stem FROM names')}), "
    f"b0 AS ({_signed('SELECT w AS id, w[2] AS word, w[2] AS stem FROM names')}), "
    f"p AS (SELECT a.word AS a_word, b.word AS b_word, {FEATURE_COLUMNS} FROM a0 a JOIN b0 b ON a.id = b.id) "
    f"SELECT a_word, b_word, {ROUNDED} FROM p",
    "ngram_jaccard3": f"WITH {BENCH}, g AS (SELECT idx, word, list_distinct(list_transform(range(1, len - 1), "
    "lambda i: substr(word, i, 3))) AS grams FROM v) "
    f"SELECT a.word AS a_word, b.word AS b_word, round({F3}, 6) AS ratio FROM {NEXT.replace('v a', 'g a').replace('v b', 'g b')}",
    "lcs_ratio": f"WITH {BENCH} SELECT a.word AS a_word, b.word AS b_word, round({LCS_RATIO}, 6) AS ratio FROM {NEXT}",
    "candidate_pairs": f"WITH {BENCH} SELECT a.word AS a_word, b.word AS b_word FROM v a JOIN v b ON {BAND} WHERE {F1} >= 0.3",
    "positive_pairs": f"WITH {vocabulary('v', 'documents', 'text')}, p AS ({POSITIVE}) "
    "SELECT a_idx, b_idx, a_word, b_word, round(f2, 6) AS f2, round(f6, 6) AS f6 FROM p",
    "negative_pairs": f"WITH {BENCH}, {NEGATIVE} SELECT draw, a_word, b_word, CAST(0 AS DOUBLE) AS label FROM neg",
    "negative_pairs_loose": f"WITH {BENCH}, {NEGATIVE}, loose AS (SELECT draw, a_word, b_word FROM picked "
    "WHERE levenshtein(a_word, b_word) > greatest(la, lb) // 2 "
    "QUALIFY row_number() OVER (ORDER BY draw) <= (SELECT goal FROM goal)) "
    "SELECT draw, a_word, b_word, CAST(0 AS DOUBLE) AS label FROM loose",
    "label_counts": f"WITH {BENCH}, {NEGATIVE} SELECT CAST(1 AS DOUBLE) AS label, count(*) AS pairs FROM pos "
    "UNION ALL SELECT CAST(0 AS DOUBLE), count(*) FROM neg",
    "score_pairs_fixed": f"WITH {BENCH}, p AS (SELECT a.word AS a_word, b.word AS b_word, a.len AS la, b.len AS lb, {FEATURE_COLUMNS} FROM {NEXT}), "
    f"q AS (SELECT *, {PROB} AS ml_prob FROM p) SELECT a_word, b_word, round(ml_prob, 6) AS ml_prob, "
    f"round(CASE WHEN abs(la - lb) > 3 OR f6 < 0.25 THEN 0 ELSE {_score()} END, 6) AS score FROM q",
    "evaluate_fixed": f"WITH {BENCH}, p AS (SELECT {FEATURE_COLUMNS} FROM {NEXT}), "
    f"q AS (SELECT {PROB} > 0.5 AS said, f2 > 0.6 AND f6 > 0.5 AS truth FROM p), "
    "c AS (SELECT count(*) FILTER (said AND truth) AS tp, count(*) FILTER (said AND NOT truth) AS fp, "
    "count(*) FILTER (NOT said AND truth) AS fn, count(*) FILTER (said = truth) AS hit, count(*) AS n FROM q) "
    "SELECT round(coalesce(hit::DOUBLE / nullif(n, 0), 0), 6) AS acc, "
    "round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS prec, "
    "round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS rec, "
    "round(coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c",
    "similar_shape_fixed": f"WITH {BENCH}, {_hits('v', 'v')} SELECT {HIT_COLUMNS} FROM top",
    "similar_shape_lcs": f"WITH {BENCH}, {_hits('v', 'v', LCS_RATIO)} SELECT {HIT_COLUMNS} FROM top",
    "similar_shape_documents": f"WITH {BENCH}, {vocabulary('d', 'documents', 'text')}, {_hits('v', 'd')} "
    f"SELECT {HIT_COLUMNS} FROM top",
    "similar_shape_few": f"WITH {vocabulary('v', 'part', 'p_name')}, {vocabulary('d', 'documents', 'text')}, "
    f"{_hits('v', 'd')} SELECT {HIT_COLUMNS} FROM top",
    "vector_similarity": "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) "
    f"SELECT a.vec_id, round({_similarity('cosine', 'a.v', 'b.v')}, 6) AS cosine, "
    f"round({_similarity('euclidean', 'a.v', 'b.v')}, 6) AS euclidean, "
    f"round({_similarity('manhattan', 'a.v', 'b.v')}, 6) AS manhattan FROM e a JOIN e b ON b.vec_id = a.vec_id + 1",
    "semantic_pair_score": "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) "
    "SELECT a.vec_id AS a_id, b.vec_id AS b_id, round(list_cosine_similarity(a.v, b.v), 6) AS score "
    "FROM e a JOIN e b ON a.vec_id = b.vec_id // 2",
    **{
        f"similar_semantic_{m}": f"WITH {ROWS}, {_near_vectors(m)} "
        "SELECT qid, rank, idx, word, meaning, round(score, 6) AS score FROM near_v"
        for m in ("cosine", "euclidean", "manhattan")
    },
    "similar_both": _lines(
        "string_agg(CAST(idx AS VARCHAR), ',' ORDER BY rank)",
        "string_agg(CAST(idx AS VARCHAR), ',' ORDER BY rank)",
        "r.word, r.meaning, ",
    ),
    "format_hits": _lines(
        "string_agg(format('{}({:.3f})：{}', hit, score, meaning), '; ' ORDER BY rank)",
        "string_agg(format('{}:{}({:.3f})', word, meaning, score), '; ' ORDER BY rank)",
        "",
    ),
    "nearest_centroid": "WITH x AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS x, "
    "generate_subscripts(embedding, 1) AS i FROM embeddings), "
    "c AS (SELECT label, i, avg(x) AS m FROM x GROUP BY label, i), "
    "d AS (SELECT vec_id, c.label, sum((x - m) * (x - m)) AS d FROM x JOIN c USING (i) GROUP BY vec_id, c.label) "
    "SELECT vec_id, arg_min(label, (d, label)) AS semantic_cluster FROM d GROUP BY vec_id",
    "read_dictionary": f"SELECT {HEADWORD} AS word, text AS meaning FROM documents",
    "read_dictionary_gb18030": f"SELECT {HEADWORD} AS word, concat('义', text) AS meaning FROM documents",
    "read_dictionary_first_rows": f"SELECT row_number() OVER (ORDER BY word, meaning) - 1 AS idx, word, meaning FROM "
    f"(SELECT {HEADWORD} AS word, text AS meaning FROM documents) ORDER BY idx LIMIT 100",
}
ORACLES["stream_lookup"] = ORACLES["similar_shape_fixed"]
ORACLES["stream_lookup_meanings"] = ORACLES["similar_semantic_cosine"]
# The plans of large query tables give the rows of the small ones.
for small, large in (
    ("similar_shape_fixed", "similar_shape_tiles"),
    ("similar_shape_lcs", "similar_shape_lcs_tiles"),
    ("similar_semantic_cosine", "similar_semantic_blocks_cosine"),
    ("similar_semantic_euclidean", "similar_semantic_blocks_euclidean"),
    ("similar_semantic_manhattan", "similar_semantic_blocks_manhattan"),
    ("similar_both", "similar_both_large"),
):
    ORACLES[large] = ORACLES[small]
