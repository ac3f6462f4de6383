"""DuckDB SQL for the queries, written apart from their Spark form."""

from __future__ import annotations

# The values below are written out again: these queries check those of the library.
BLANK = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ZERO_WIDTH_EVAL = "\u200b\u200c\u200d\u200e\u200f\ufeff"
ZERO_WIDTH = ZERO_WIDTH_EVAL + "\u00ad"
ODIA = r"[\x{0B00}-\x{0B7F}]"


def _count(t: str, pattern: str) -> str:
    return f"length(regexp_extract_all({t}, '{pattern}'))"


def _strip(t: str, chars: str = ZERO_WIDTH) -> str:
    return f"translate({t}, '{chars}', '')"


def _collapse(t: str) -> str:
    return f"trim(regexp_replace({t}, '{BLANK}+', ' ', 'g'))"


def _norm(t: str) -> str:
    return _collapse(_strip(f"nfc_normalize({t})"))


def _letters(t: str) -> str:
    return f"length(regexp_replace({t}, '[^\\p{{L}}]', '', 'g'))"


def _purity(t: str) -> str:
    inside = f"({_letters(t)} - length(regexp_replace({t}, '[^\\p{{L}}]|{ODIA}', '', 'g')))"
    return f"(CASE WHEN {_letters(t)} = 0 THEN 0.0 ELSE {inside}::DOUBLE / {_letters(t)} END)"


def _unit(key: str, salt: str) -> str:
    return f"(('0x' || substr(sha256('{salt}:' || {key}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616::DOUBLE)"


def _split(key: str) -> str:
    u = _unit(key, "42")
    return f"CASE WHEN {u} < 0.8::DOUBLE THEN 'train' WHEN {u} < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END"


def _r(x: str, places: int = 6) -> str:
    return f"round(({x})::DOUBLE, {places})"


def _words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '{BLANK}+'), lambda w: w <> '')"


def _div(a: str, b: str) -> str:
    return f"coalesce(({a})::DOUBLE / nullif(({b})::DOUBLE, 0), 0)"


RECORDS = "records AS (SELECT DISTINCT * FROM pairs)"
RELEASE = "rel AS (SELECT DISTINCT * FROM release)"
LATEST = """latest AS (SELECT example_id, p_hate_raw FROM (SELECT *, row_number() OVER (PARTITION BY example_id ORDER BY written_at DESC, p_hate_raw DESC) AS r
    FROM score_shards WHERE example_id IS NOT NULL AND p_hate_raw IS NOT NULL AND NOT isnan(p_hate_raw)) WHERE r = 1)"""
SCORED = f"""{RECORDS}, {LATEST}, banded AS (SELECT p.*, s.p_hate_raw, round_even(s.p_hate_raw::DOUBLE, 6) AS p_hate FROM records p JOIN latest s USING (example_id)),
scored AS (SELECT *, CASE WHEN p_hate >= 0.9::DOUBLE THEN 1 WHEN p_hate <= 0.05::DOUBLE THEN 0 END AS label FROM banded)"""
PREDICTED = f"""{RELEASE}, p0 AS (SELECT *, label::INT AS gold, CASE WHEN {_unit("example_id", "pred")} < 0.15::DOUBLE THEN 1 - label::INT ELSE label::INT END AS pred FROM rel WHERE label IS NOT NULL),
predictions AS (SELECT *, CASE WHEN pred = 1 THEN 0.5::DOUBLE + {_unit("example_id", "prob")} / 2 ELSE {_unit("example_id", "prob")} / 2 END AS prob_hate, gold = pred AS correct,
    coalesce(regexp_matches(text_eng, '[?？]'), false) AS question, length(text_eng) AS char_len FROM p0)"""
GROUPED = f"{RELEASE}, grouped AS (SELECT *, sha256({_norm('text_ory')}) AS g FROM rel WHERE text_ory IS NOT NULL)"
CELLS = "count(*) FILTER (gold = 0 AND {p} = 0) AS tn, count(*) FILTER (gold = 0 AND {p} = 1) AS fp, count(*) FILTER (gold = 1 AND {p} = 0) AS fn, count(*) FILTER (gold = 1 AND {p} = 1) AS tp"


def _cells(source: str, by: str = "", p: str = "pred") -> str:
    group = f"{by}, " if by else ""
    return f"SELECT {group}{CELLS.format(p=p)} FROM {source}" + (f" GROUP BY {by}" if by else "")


F1_1, F1_0 = _div("2 * tp", "2 * tp + fp + fn"), _div("2 * tn", "2 * tn + fp + fn")
MACRO = f"(({F1_1}) + ({F1_0})) / 2"
MCC = _div("tp::DOUBLE * tn - fp::DOUBLE * fn", "sqrt((tp + fp)::DOUBLE * (tp + fn)::DOUBLE * (tn + fp)::DOUBLE * (tn + fn)::DOUBLE)")
P1, R1, P0, R0 = _div("tp", "tp + fp"), _div("tp", "tp + fn"), _div("tn", "tn + fn"), _div("tn", "tn + fp")
ALL_METRICS = f"""tn, fp, fn, tp, tn + fp + fn + tp AS n, {_r(_div("tp + tn", "tn + fp + fn + tp"))} AS accuracy, {_r(P1)} AS precision_1, {_r(R1)} AS recall_1, {_r(F1_1)} AS f1_1,
tp + fn AS support_1, {_r(P0)} AS precision_0, {_r(R0)} AS recall_0, {_r(F1_0)} AS f1_0, tn + fp AS support_0, {_r(f"({P1} + {P0}) / 2")} AS macro_precision,
{_r(f"({R1} + {R0}) / 2")} AS macro_recall, {_r(MACRO)} AS macro_f1, {_r(MCC)} AS mcc, {_r(_div("tp + fp", "tn + fp + fn + tp"))} AS predicted_rate, {_r(_div("tp + fn", "tn + fp + fn + tp"))} AS gold_rate"""
SHORT_METRICS = f"tn + fp + fn + tp AS n, {_r(_div('tp + tn', 'tn + fp + fn + tp'))} AS accuracy, {_r(MACRO)} AS macro_f1, {_r(MCC)} AS mcc"


def _expected(prevalence: str, tpr: str, fpr: str) -> str:
    tp, fn, fp, tn = f"{prevalence} * {tpr}", f"{prevalence} * (1 - {tpr})", f"(1 - {prevalence}) * {fpr}", f"(1 - {prevalence}) * (1 - {fpr})"
    return f"({_div(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} + {_div(f'2 * {tn}', f'2 * {tn} + {fp} + {fn}')}) / 2"


def _gates(turns: bool, source: str) -> str:
    """A frame ``gated``: every row of ``source`` with its failed gates."""
    if turns:
        start = """SELECT *, eng_latn[1][1] AS e0, ory_orya[1][1] AS o0, coalesce(length(eng_latn), 0) <> coalesce(length(ory_orya), 0)
            OR coalesce(eng_latn[1][1], '') = '' OR coalesce(ory_orya[1][1], '') = '' AS shape FROM """ + source
    else:
        start = f"SELECT * RENAME (text_eng AS e0, text_ory AS o0), text_eng IS NULL OR text_ory IS NULL AS shape FROM {source}"
    return f"""framed AS (SELECT *, nfc_normalize(e0) AS text_eng, nfc_normalize(o0) AS text_ory FROM ({start})),
flagged AS (SELECT *, NOT shape AND ({_collapse("text_eng")} = '' OR {_collapse("text_ory")} = '') AS empty,
    NOT shape AND NOT length(text_eng) BETWEEN 3 AND 2000 AS el, NOT shape AND NOT length(text_ory) BETWEEN 3 AND 2000 AS ol, NOT shape AND {_purity("text_ory")} < 0.6::DOUBLE AS impure FROM framed),
gated AS (SELECT *, CASE WHEN shape THEN 'turn_shape_invalid' WHEN empty THEN 'empty_after_strip' WHEN el OR ol THEN 'length_out_of_bounds' WHEN impure THEN 'low_ory_script_purity' END AS reason,
    concat_ws('+', CASE WHEN shape THEN 'turn_shape_invalid' END, CASE WHEN empty THEN 'empty_after_strip' END, CASE WHEN el OR ol THEN 'length_out_of_bounds' END, CASE WHEN impure THEN 'low_ory_script_purity' END) AS all_failed_gates,
    concat_ws('+', CASE WHEN el THEN 'eng' END, CASE WHEN ol THEN 'ory' END) AS length_sides FROM flagged)"""


def _representatives(source: str, group: str) -> str:
    return f"""cells AS (SELECT {group}, label, source_config, count(*) AS n, min(example_id) AS first FROM {source} GROUP BY ALL),
low AS (SELECT *, min(first) OVER (PARTITION BY {group}) AS lowest, sum(n) OVER (PARTITION BY {group})::BIGINT AS cluster_size, count(*) OVER (PARTITION BY {group}) AS cells FROM cells),
reps AS (SELECT {group}, first AS example_id, label, source_config, cluster_size, cells FROM low
    QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY n DESC, first <> lowest, label NULLS FIRST, source_config NULLS FIRST) = 1)"""


def _draw(source: str, group: str, key: str, quotas: str, seed: str = "42") -> str:
    """Rows of ``source`` within the quotas of a frame (group, quota)."""
    return f"""(SELECT s.* FROM {source} s JOIN {quotas} q ON s.{group} = q.{group} WHERE quota > 0
    QUALIFY row_number() OVER (PARTITION BY s.{group} ORDER BY sha256('{seed}:' || s.{group} || ':' || {key}), {key}) <= quota)"""


def _remainder(counts: str, group: str, total: str) -> str:
    """A frame (group, n, quota) by largest remainder of a frame (group, n)."""
    return f"""(SELECT {group}, n, (f + CASE WHEN row_number() OVER (ORDER BY f - x, {group}) <= total - sum(f) OVER () THEN 1 ELSE 0 END)::BIGINT AS quota
    FROM (SELECT *, floor(x) AS f FROM (SELECT {group}, n, n / sum(n) OVER () * ({total})::DOUBLE AS x, {total} AS total FROM {counts})))"""


SUITE = f"""items AS (SELECT *, (tier = 'clear_hate')::INT AS gold,
    round(CASE WHEN tier = 'clear_hate' THEN 0.7::DOUBLE ELSE 0::DOUBLE END + round_even({_unit("id", "score")}, 6) * 0.3::DOUBLE, 6) AS score FROM canary_items)"""
BALANCE_QUOTA = f"""{RELEASE}, known AS (SELECT * FROM rel WHERE label IS NOT NULL AND source_config IS NOT NULL),
hate AS (SELECT * FROM known WHERE label = 1), other AS (SELECT * FROM known WHERE label = 0),
oc AS (SELECT source_config, count(*) AS n FROM other GROUP BY 1)"""
EDGES = (0.0, 0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0)
BINS = "bins AS (SELECT * FROM (VALUES " + ", ".join(f"({i}::INT, {a}::DOUBLE, {b}::DOUBLE)" for i, (a, b) in enumerate(zip(EDGES, EDGES[1:]))) + ") t(bin, lower, upper))"
FEATURES = {
    "char_length": "length(t)", "token_count": f"length({_words('t')})",
    "mean_word_length": _r(f"coalesce(list_sum(list_transform({_words('t')}, lambda w: length(w)))::DOUBLE / nullif(length({_words('t')}), 0), 0)"),
    "question_marks": _count("t", r"\?"), "exclamations": _count("t", "!"), "periods": _count("t", r"\."), "commas": _count("t", ","),
    "digits": _count("t", r"\p{Nd}"), "uppercase": _count("t", r"\p{Lu}"), "purity": _r(_purity("t")),
    "scaffold": "(contains(lower(t), '<s>') OR contains(lower(t), '[inst]') OR contains(t, '[ଇନ୍ସ୍ଟ]') OR contains(lower(t), '<<sys>>'))::INT",
}
SURFACE = {
    "char_len": "length(t)", "token_count": f"length({_words('t')})", "question_marks": _count("t", r"\?"), "exclamations": _count("t", "!"), "commas": _count("t", ","), "periods": _count("t", r"\."),
    "digits": _count("t", r"\p{Nd}"), "uppercase_latin": _count("t", "[A-Z]"), "odia_ratio": _r(f"{_count('t', ODIA)}::DOUBLE / greatest(length(t), 1)"),
    "mean_word_len": _r(f"length(t)::DOUBLE / greatest(length({_words('t')}), 1)"),
}
ONES = "'hate', 'hateful', 'hate_speech', 'hs', 'yes', '1', 'true', 'offensive', 'toxic', 'abusive'"
ZEROS = "'non_hate', 'nonhate', 'not_hate', 'nothate', 'none', 'no', '0', 'false', 'normal', 'neutral', 'clean', 'not_offensive', 'non-hate', 'not-hate'"


def oracle_sql() -> dict[str, str]:
    columns = lambda d: ", ".join(f"{e} AS {n}" for n, e in d.items())
    short = lambda by: f"WITH {PREDICTED}, c AS ({_cells('predictions', by)}) SELECT {by}, {SHORT_METRICS} FROM c"
    lengths = "CASE WHEN char_len >= 0 AND char_len <= 50 THEN '0-50' WHEN char_len <= 100 THEN '50-100' WHEN char_len <= 200 THEN '100-200' WHEN char_len <= 400 THEN '200-400' WHEN char_len <= 10000 THEN '400-10000' END"
    straddle = "SELECT g, string_agg(DISTINCT part, ',' ORDER BY part) AS splits FROM s GROUP BY g HAVING count(DISTINCT part) > 1"
    percentiles = ", ".join(f"trunc(quantile_cont(n_chars, {q}))::INT AS {n}" for q, n in ((0.5, "p50"), (0.75, "p75"), (0.9, "p90"), (0.95, "p95"), (0.99, "p99"), (0.999, "p99_9")))
    over = ", ".join(f"{_r(f'avg((n_chars > {c})::INT)')} AS over_{c}" for c in (64, 128, 256, 512, 1024, 2048, 4096))
    mi = f"""WITH {RELEASE}, c AS (SELECT source_config x, label y, count(*)::DOUBLE n FROM rel WHERE source_config IS NOT NULL AND label IS NOT NULL GROUP BY 1, 2),
        mx AS (SELECT x, sum(n) nx FROM c GROUP BY 1), my AS (SELECT y, sum(n) ny FROM c GROUP BY 1), t AS (SELECT sum(n) total FROM c),
        g AS (SELECT coalesce(n, 0) n, nx, ny, total FROM mx CROSS JOIN my CROSS JOIN t LEFT JOIN c USING (x, y)),
        s AS (SELECT sum(CASE WHEN n > 0 THEN n / total * ln(n * total / (nx * ny)) ELSE 0 END) mi, sum(pow(n - nx * ny / total, 2) / (nx * ny / total)) chi2, any_value(total) total FROM g),
        h AS (SELECT (SELECT -sum(nx / total * ln(nx / total)) FROM mx, t) hx, (SELECT -sum(ny / total * ln(ny / total)) FROM my, t) hy, (SELECT least((SELECT count(*) FROM mx), (SELECT count(*) FROM my)) - 1) k)
        SELECT {_r("mi")} mi, {_r("hx")} hx, {_r("hy")} hy, {_r(_div("2 * mi", "hx + hy"))} nmi_arithmetic, {_r(_div("mi", "least(hx, hy)"))} nmi_min, {_r(_div("mi", "greatest(hx, hy)"))} nmi_max,
        {_r("sqrt(" + _div("chi2", "total * k") + ")")} cramers_v FROM s, h"""
    features = f"WITH p AS (SELECT example_id, text_ory AS t FROM pairs WHERE text_ory IS NOT NULL), f AS (SELECT example_id, {columns(FEATURES)} FROM p)"
    yields = lambda name: f"{_r(_div(f'{name} * 100.0', 'total'))} AS {name}_pct"
    band = "CASE WHEN p >= 0.9::DOUBLE THEN 1 WHEN p <= 0.05::DOUBLE THEN 0 END"
    match = f"""WITH {BALANCE_QUOTA} SELECT source_config, label, count(*) AS n FROM hate GROUP BY ALL
        UNION ALL SELECT source_config, 0, count(*) FROM hate GROUP BY ALL"""
    return {
        "f1_turn0_prompt": "SELECT doc_id, eng_latn[1][1] AS eng, ory_orya[1][1] AS ory FROM raw_conversations",
        "f2_turn_display": "SELECT doc_id, " + ", ".join(f"CASE WHEN coalesce(length({c}), 0) <= 1 THEN '<MISSING TURN>' WHEN coalesce({c}[2][1], '') = '' THEN '<EMPTY TURN>' ELSE {c}[2][1] END AS {n}" for c, n in (("eng_latn", "eng"), ("ory_orya", "ory"))) + " FROM raw_conversations",
        "f3_strip_zero_width": f"SELECT example_id, {_strip('text_ory')} AS text FROM pairs",
        "f4_collapse_whitespace": f"SELECT example_id, {_collapse('text_ory')} AS text FROM pairs",
        "f5_normalise": f"SELECT example_id, {_norm('text_ory')} AS text FROM pairs",
        "f6_normalise_eval": "SELECT example_id, " + _collapse(_strip("nfc_normalize(coalesce(text_eng, ''))", ZERO_WIDTH_EVAL)) + " AS text FROM pairs",
        "f7_script_purity": f"SELECT example_id, CASE WHEN text_ory IS NOT NULL THEN {_r(_purity('text_ory'))} END AS purity FROM pairs",
        "f8_script_of": f"SELECT lang, CASE WHEN text IS NULL THEN NULL WHEN {_letters('text')} = 0 THEN 'no_letters' WHEN {_purity('text')} >= 0.6::DOUBLE THEN 'odia_script' WHEN {_purity('text')} > 0 THEN 'mixed' ELSE 'romanized' END AS script, count(*) AS n FROM documents GROUP BY ALL",
        "f9_example_id": "SELECT example_id, substr(sha256(source_config || '|' || doc_id), 1, 16) AS made FROM pairs",
        "f10_unit_fraction": f"SELECT example_id, {_unit('example_id', '42')} AS u FROM pairs",
        "f11_assign_split": f"SELECT example_id, {_split('example_id')} AS part FROM pairs",
        "f12_shingles": f"SELECT example_id, CASE WHEN t IS NULL THEN NULL WHEN t = '' THEN 0 ELSE length(list_distinct(list_transform(range(1, greatest(length(t) - 4, 1) + 1), lambda i: substr(t, i::BIGINT, 5)))) END::INT AS n FROM (SELECT example_id, {_norm('text_ory')} AS t FROM pairs)",
        "f13_band": f"SELECT {band} AS label, count(*) AS n FROM (SELECT CASE WHEN NOT isnan(p_hate_raw) THEN round_even(p_hate_raw::DOUBLE, 6) END AS p FROM score_shards) GROUP BY ALL",
        "f14_rounded": "SELECT example_id, shard, round_even(p_hate_raw::DOUBLE, 6) AS p_hate FROM score_shards",
        "f15_near_bound": "SELECT * FROM (SELECT example_id, shard, round_even(p_hate_raw::DOUBLE, 6) AS p FROM score_shards) WHERE abs(p - 0.9::DOUBLE) <= 0.001::DOUBLE OR abs(p - 0.05::DOUBLE) <= 0.001::DOUBLE",
        "f16_is_question": "SELECT example_id, coalesce(regexp_matches(text_eng, '[?？]'), false) AS question FROM pairs",
        "f17_features": f"{features} SELECT * FROM f",
        "f18_surface_features": f"SELECT example_id, {columns(SURFACE)} FROM (SELECT example_id, text_ory AS t FROM pairs WHERE text_ory IS NOT NULL)",
        "f19_coerced_label": f"WITH {RELEASE} SELECT example_id, CASE WHEN try_cast(raw AS DOUBLE) = 1 THEN 1 WHEN try_cast(raw AS DOUBLE) = 0 THEN 0 WHEN name IN ({ONES}) THEN 1 WHEN name IN ({ZEROS}) THEN 0 END AS label FROM (SELECT example_id, raw, replace(lower(trim(raw)), ' ', '_') AS name FROM (SELECT example_id, coalesce(lower(label_str), label::VARCHAR) AS raw FROM rel))",
        "f20_length_sides": f"WITH {_gates(False, '(SELECT example_id, text_eng, text_ory FROM rejects)')} SELECT length_sides, count(*) AS n FROM gated WHERE length_sides <> '' GROUP BY 1",
        "f22_yield_verdict": f"WITH {SCORED} SELECT source_config, count(*) AS n, CASE WHEN count(*) >= 10000 THEN 'FINE' WHEN count(*) >= 2000 THEN 'WORKABLE' ELSE 'STOP' END AS verdict FROM scored WHERE label IS NOT NULL GROUP BY 1",
        "f24_expected_macro_f1": f"WITH {PREDICTED}, c AS ({_cells('predictions', 'source_config')}), r AS (SELECT source_config, {R1} AS tpr, {_div('fp', 'fp + tn')} AS fpr, {_div('tp + fn', 'tn + fp + fn + tp')} AS prevalence FROM c) SELECT source_config, {_r('tpr')} AS tpr, {_r('fpr')} AS fpr, {_r('prevalence')} AS prevalence, {_r('(tpr + 1 - fpr) / 2')} AS balanced_accuracy, {_r(_expected('0.01::DOUBLE', 'tpr', 'fpr'))} AS expected FROM r",
        "f26_excerpt": "SELECT example_id, substr(text_eng, 1, 150) AS excerpt FROM rejects",
        "g1_gates": f"WITH {_gates(True, 'raw_conversations')} SELECT doc_id, text_eng, text_ory, reason, all_failed_gates FROM gated",
        "g2_rejected": f"WITH {_gates(False, '(SELECT example_id, text_eng, text_ory FROM rejects)')} SELECT example_id, reason AS found FROM gated WHERE reason IS NOT NULL",
        "g3_drop_counts": f"WITH {RECORDS}, {_gates(False, 'records')} SELECT source_config, coalesce(reason, 'kept') AS reason, count(*) AS n FROM gated GROUP BY ALL",
        "g3_co_failures": f"WITH {_gates(True, 'raw_conversations')} SELECT all_failed_gates, count(*) AS n FROM gated WHERE all_failed_gates <> '' GROUP BY 1",
        "g4_breaches": f"WITH {RECORDS}, {_gates(False, 'records')}, c AS (SELECT source_config, reason AS gate, count(*) AS dropped, any_value(rows) AS rows FROM (SELECT *, count(*) OVER (PARTITION BY source_config) AS rows FROM gated) WHERE reason IS NOT NULL GROUP BY ALL) SELECT source_config, rows, gate, dropped, {_r('dropped * 100.0 / rows')} AS pct FROM c WHERE dropped * 100.0 / rows > 1.0",
        "g5_discarded": f"WITH {SCORED} SELECT example_id, p_hate FROM scored WHERE label IS NULL",
        "g9_split_overlap": f"WITH {RECORDS}, s AS (SELECT DISTINCT {_norm('text_ory')} AS v, {_split('example_id')} AS part FROM records WHERE text_ory IS NOT NULL) SELECT a.part AS split_a, b.part AS split_b, count(*) AS shared FROM s a JOIN s b ON a.v = b.v AND a.part < b.part GROUP BY ALL",
        "g10_straddling_rows": f"WITH {RECORDS}, s AS (SELECT sha256({_norm('text_ory')}) AS g, {_split('example_id')} AS part FROM records WHERE text_ory IS NOT NULL) {straddle}",
        "g10_straddling_groups": f"WITH {RECORDS}, k AS (SELECT sha256({_norm('text_ory')}) AS g FROM records WHERE text_ory IS NOT NULL), s AS (SELECT g, {_split('g')} AS part FROM k) {straddle}",
        "j1_attach_scores": f"WITH {SCORED} SELECT example_id, source_config, p_hate_raw, p_hate FROM scored",
        "j2_coverage": "WITH w AS (SELECT DISTINCT example_id FROM pairs WHERE example_id IS NOT NULL), f AS (SELECT example_id, count(*) AS times FROM score_shards WHERE example_id IS NOT NULL GROUP BY 1) SELECT count(w.example_id) AS wanted, count(f.example_id) AS found, count(*) FILTER (f.example_id IS NULL) AS missing, count(*) FILTER (w.example_id IS NULL) AS unexpected, count(*) FILTER (times > 1) AS repeated FROM w FULL JOIN f ON w.example_id = f.example_id",
        "j3_still_to_do": f"WITH {LATEST} SELECT DISTINCT example_id FROM pairs WHERE example_id IS NOT NULL AND example_id NOT IN (SELECT example_id FROM latest)",
        "j6_agreement": f"WITH {RELEASE}, j AS (SELECT label_str AS teacher, CASE WHEN u < 0.1::DOUBLE THEN '' WHEN u < 0.3::DOUBLE THEN 'HATE' ELSE upper(label_str) END AS human FROM (SELECT *, {_unit('example_id', 'human')} AS u FROM rel WHERE label_str IS NOT NULL)) SELECT teacher, count(*) AS n, count(*) FILTER (human = teacher) AS agreed, {_r('avg((human = teacher)::INT)')} AS agreement FROM j WHERE human <> '' GROUP BY 1",
        "j8_variant_difference": f"""WITH {BALANCE_QUOTA}, q AS {_remainder('oc', 'source_config', '(SELECT count(*) FROM hate)')},
            a AS (SELECT example_id FROM {_draw('other', 'source_config', 'example_id', 'q')}), b AS (SELECT example_id FROM {_draw('other', 'source_config', 'example_id', 'q', '7')})
            SELECT example_id, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT example_id, 'right' FROM (FROM b EXCEPT ALL FROM a)""",
        "u2_unscored": "SELECT example_id FROM pairs EXCEPT SELECT example_id FROM score_shards",
        "u3_shared_texts": f"WITH {RECORDS}, s AS (SELECT {_norm('text_eng')} AS norm, {_split('example_id')} AS part FROM records WHERE text_eng IS NOT NULL) SELECT norm FROM s WHERE part = 'train' INTERSECT SELECT norm FROM s WHERE part = 'test'",
        "a1_yields": f"WITH {SCORED}, c AS (SELECT source_config, grouping(source_config) = 1 AS is_total, count(*) AS total, count(*) FILTER (label = 1) AS hate, count(*) FILTER (label = 0) AS non_hate, count(*) FILTER (label IS NULL) AS discarded FROM scored GROUP BY ROLLUP (source_config)) SELECT *, {yields('hate')}, {yields('non_hate')}, {yields('discarded')} FROM c",
        "a2_histogram": f"WITH {SCORED}, {BINS}, c AS (SELECT source_config, bin, count(*) AS n FROM scored JOIN bins ON p_hate >= lower AND (p_hate < upper OR bin = 13 AND p_hate <= upper) GROUP BY ALL), k AS (SELECT DISTINCT source_config FROM c), g AS (SELECT k.source_config, b.*, coalesce(c.n, 0) AS n FROM k CROSS JOIN bins b LEFT JOIN c ON c.source_config IS NOT DISTINCT FROM k.source_config AND c.bin = b.bin) SELECT *, {_r('n * 100.0 / sum(n) OVER (PARTITION BY source_config)')} AS pct FROM g",
        "a3_contingency": f"WITH {RELEASE}, k AS (SELECT source_config, label FROM rel WHERE source_config IS NOT NULL AND label IS NOT NULL), c AS (SELECT source_config, label, count(*) AS n FROM k GROUP BY ALL) SELECT source_config, label, coalesce(n, 0) AS n FROM (SELECT DISTINCT source_config FROM k) CROSS JOIN (SELECT DISTINCT label FROM k) LEFT JOIN c USING (source_config, label)",
        "a4_mutual_information": mi,
        "a6_label_shares": f"WITH {RELEASE}, c AS (SELECT label, source_config, count(*) AS n FROM rel WHERE source_config IS NOT NULL AND label IS NOT NULL GROUP BY ALL), s AS (SELECT *, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY label) AS p FROM c) SELECT label, source_config, n, {_r('p')} AS pct, row_number() OVER (PARTITION BY label ORDER BY n DESC, source_config) = 1 AS top, p >= 95 AS alarm FROM s",
        "a7_exact_groups": f"WITH {RECORDS} SELECT min(example_id) AS text_key, count(*) AS members FROM records WHERE text_ory IS NOT NULL GROUP BY {_norm('text_ory')}",
        "a8_size_histogram": f"WITH {GROUPED}, c AS (SELECT g, count(*) AS n FROM grouped GROUP BY 1) SELECT CASE WHEN n = 1 THEN '1' WHEN n = 2 THEN '2' WHEN n <= 5 THEN '3-5' WHEN n <= 10 THEN '6-10' WHEN n <= 50 THEN '11-50' WHEN n <= 100 THEN '51-100' ELSE '100+' END AS size, count(*) AS clusters FROM c GROUP BY 1",
        "a9_spanning": f"WITH {GROUPED}, c AS (SELECT DISTINCT g, label, source_config FROM grouped), p AS (SELECT g, count(*) AS cells, count(DISTINCT label) AS labels FROM c GROUP BY 1) SELECT count(*) FILTER (cells > 1) AS cell_spanning, count(*) FILTER (labels > 1) AS label_conflicts FROM p",
        "a10_three_way": f"WITH {RELEASE}, s AS (SELECT *, {_split('example_id')} AS part FROM rel) SELECT part, label, source_config, grouping(part, label, source_config) AS level, count(*) AS n FROM s GROUP BY GROUPING SETS ((part, label, source_config), (part, label), (part))",
        "a11_split_shares": f"WITH {RELEASE}, s AS (SELECT *, {_split('example_id')} AS part FROM rel) SELECT label, source_config, count(*) AS n, " + ", ".join(f"{_r(f'avg((part = {x!r})::INT)')} AS {x}" for x in ("train", "validation", "test")) + " FROM s GROUP BY ALL",
        "a12_metrics": f"WITH {PREDICTED}, c AS ({_cells('predictions')}) SELECT {ALL_METRICS} FROM c",
        "a13_metrics_by_source": short("source_config"),
        "a13_metrics_by_mood": short("question"),
        "a14_metrics_by_length": f"WITH {PREDICTED}, b AS (SELECT *, {lengths} AS length_bin FROM predictions), c AS ({_cells('b', 'length_bin')}) SELECT length_bin, tn + fp + fn + tp AS n, {_r(MACRO)} AS macro_f1 FROM c WHERE length_bin IS NOT NULL",
        "a15_mood_by_error": f"""WITH {PREDICTED}, k AS (SELECT count(*) FILTER (NOT question AND correct) AS a, count(*) FILTER (NOT question AND NOT correct) AS b, count(*) FILTER (question AND correct) AS c, count(*) FILTER (question AND NOT correct) AS d FROM predictions),
            m AS (SELECT *, (a + b + c + d)::DOUBLE AS n, (a + b)::DOUBLE * (c + d) * (a + c) * (b + d) AS margins, abs(a::DOUBLE * d - b::DOUBLE * c) AS off FROM k),
            x AS (SELECT *, {_div("n * pow(greatest(off - n * least(0.5::DOUBLE, off / n), 0), 2)", "margins")} AS chi2 FROM m)
            SELECT a, b, c, d, margins > 0 AS applicable, {_r("chi2")} AS chi2, {_r("sqrt(chi2 / n)")} AS phi FROM x""",
        "a16_mood_prediction": f"WITH {PREDICTED}, s AS (SELECT avg(question::INT) AS question_share, avg(pred) AS predicted, avg(gold) AS gold FROM predictions) SELECT {_r('question_share')} AS question_share, {_r('predicted')} AS predicted, {_r('gold')} AS gold, {_r('predicted - gold')} AS bias, CASE WHEN question_share < 0.35 THEN predicted - gold > 0.02 WHEN question_share > 0.65 THEN predicted - gold < -0.02 END AS as_expected FROM s",
        "a17_confidence": f"WITH {PREDICTED}, s AS (SELECT correct, greatest(prob_hate, 1 - prob_hate) AS top FROM predictions) SELECT {_r('avg(top) FILTER (correct)')} AS mean_when_right, {_r('avg(top) FILTER (NOT correct)')} AS mean_when_wrong, count(*) FILTER (NOT correct AND top > 0.9::DOUBLE) AS confident_errors FROM s",
        "a18_kappa": f"WITH {PREDICTED}, c AS ({_cells('predictions')}), s AS (SELECT tn + fp + fn + tp AS n, (tp + tn)::DOUBLE / (tn + fp + fn + tp) AS po, ((tn + fp)::DOUBLE * (tn + fn) + (fn + tp)::DOUBLE * (fp + tp)) / pow(tn + fp + fn + tp, 2) AS pe FROM c), k AS (SELECT *, (po - pe) / (1 - pe) AS kappa FROM s) SELECT n, {_r('po')} AS po, {_r('pe')} AS pe, {_r('kappa')} AS kappa, CASE WHEN kappa >= 0.81 THEN 'almost perfect' WHEN kappa >= 0.61 THEN 'substantial' WHEN kappa >= 0.41 THEN 'moderate' WHEN kappa >= 0.21 THEN 'fair' WHEN kappa >= 0 THEN 'slight' ELSE 'poor' END AS word FROM k",
        "a19_suite_rollup": f"WITH {SUITE}, c AS (SELECT tier, count(*) AS n, count(*) FILTER (gold = 1) AS hateful, avg(score) AS m, count(*) FILTER (score >= 0.9::DOUBLE) AS band_hate, count(*) FILTER (score <= 0.05::DOUBLE) AS band_non_hate, count(*) FILTER (score > 0.05::DOUBLE AND score < 0.9::DOUBLE) AS band_discard, bool_and(gold = 1) AS gold_is_hateful FROM items GROUP BY 1) SELECT tier, n, hateful, {_r('m')} AS mean_score, band_hate, band_non_hate, band_discard, gold_is_hateful, CASE WHEN gold_is_hateful THEN {_r('band_hate::DOUBLE / n')} END AS recall_at_band, CASE WHEN NOT gold_is_hateful THEN {_r('band_non_hate::DOUBLE / n')} END AS correct_reject_at_band FROM c",
        "a19_suite_overall": f"WITH {SUITE} SELECT {_r(_div('count(*) FILTER (gold = 1 AND score >= 0.9::DOUBLE)', 'count(*) FILTER (gold = 1)'))} AS recall, {_r(_div('count(*) FILTER (gold = 0 AND score <= 0.05::DOUBLE)', 'count(*) FILTER (gold = 0)'))} AS correct_reject, {_r(_div('count(*) FILTER (gold = 0 AND score >= 0.9::DOUBLE)', 'count(*) FILTER (gold = 0)'))} AS false_hate FROM items",
        "a20_orientation": f"WITH {SUITE}, s AS (SELECT avg(score) FILTER (tier = 'clear_hate') AS mean_hate, avg(score) FILTER (tier = 'clear_benign') AS mean_benign, min(score) FILTER (tier = 'clear_hate') AS min_hate, max(score) FILTER (tier = 'clear_benign') AS max_benign FROM items) SELECT {_r('mean_hate')} AS mean_hate, {_r('mean_benign')} AS mean_benign, {_r('min_hate')} AS min_hate, {_r('max_benign')} AS max_benign, coalesce(mean_hate - mean_benign > 0.5 AND min_hate > max_benign, false) AS oriented FROM s",
        "a21_pinned": f"WITH {SUITE}, s AS (SELECT tier, count(*) AS n, min(score) AS lowest, max(score) AS highest FROM items WHERE NOT coalesce(documented_failure, false) GROUP BY 1) SELECT *, CASE tier WHEN 'clear_hate' THEN lowest >= 0.7::DOUBLE WHEN 'clear_benign' THEN highest <= 0.3::DOUBLE WHEN 'hard_negative' THEN highest <= 0.2::DOUBLE END AS passed FROM s",
        "a22_alignment": "SELECT count(*) AS rows, count(DISTINCT doc_id) AS unique_docs, count(doc_id) - count(DISTINCT doc_id) AS repeated_docs, count(*) FILTER (coalesce(length(eng_latn), 0) <> coalesce(length(ory_orya), 0)) AS turn_mismatches FROM raw_conversations",
        "a22_collisions": "WITH m AS (SELECT DISTINCT source_config, doc_id FROM pairs WHERE source_config IS NOT NULL AND doc_id IS NOT NULL), p AS (SELECT substr(sha256(source_config || '|' || doc_id), 1, 16) AS id, count(*) AS n FROM m GROUP BY 1) SELECT coalesce(sum(n), 0)::BIGINT AS documents, count(*) AS ids, count(*) FILTER (n > 1) AS collisions FROM p",
        "a22_turn_histogram": "SELECT CASE WHEN num_turns IS NULL OR isnan(num_turns) THEN -1 ELSE trunc(num_turns)::INT END AS turns, count(*) AS n FROM raw_conversations GROUP BY 1",
        "a23_length_profile": f"SELECT source, {_r('avg(n_chars)')} AS mean, max(n_chars) AS max, {over}, {percentiles} FROM documents GROUP BY 1",
        "a25_floors": f"WITH {PREDICTED}, k AS (SELECT gold, sha256('rand:' || example_id) AS d, (SELECT count(*) FILTER (gold = 1) > count(*) FILTER (gold = 0) FROM predictions) AS more FROM predictions), v AS (SELECT 'always_1' AS floor, -1 AS i, gold, 1 AS p FROM k UNION ALL SELECT 'always_0', -1, gold, 0 FROM k UNION ALL SELECT 'majority', -1, gold, more::INT FROM k UNION ALL SELECT 'random', i, gold, (substr(d, i + 1, 1) >= '8')::INT FROM k CROSS JOIN range(25) r(i)), c AS ({_cells('v', 'floor, i', 'p')}) SELECT floor, {_r(f'avg({MACRO})')} AS macro_f1 FROM c GROUP BY 1",
        "a26_question_rule": f"WITH {PREDICTED}, w AS (SELECT gold, CASE WHEN question THEN 0 ELSE 1 END AS rule FROM predictions), c AS ({_cells('w', '', 'rule')}) SELECT {ALL_METRICS} FROM c",
        "a27_probe": f"WITH {SUITE}, s AS (SELECT avg(score) AS m, max(score) AS x, count(*) AS n, count(*) FILTER (score >= 0.5::DOUBLE) AS a, count(*) FILTER (score >= 0.9::DOUBLE) AS b FROM items WHERE tier = 'question_form') SELECT {_r('m')} AS mean, {_r('x')} AS max, n, a AS from_50, b AS from_90, CASE WHEN m >= 0.5 THEN 'responds' WHEN x >= 0.5 THEN 'responds to some' ELSE 'does not respond' END AS reading FROM s",
        "a28_label_counts": f"WITH {RELEASE} SELECT label, count(*) AS n FROM rel WHERE {_split('example_id')} = 'train' GROUP BY 1",
        "a29_funnel": f"""WITH {SCORED}, {_gates(False, 'scored')}, k AS (SELECT * FROM gated WHERE reason IS NULL), l AS (SELECT * FROM k WHERE label IS NOT NULL),
            n AS (SELECT (SELECT count(*) FROM gated) AS a, (SELECT count(*) FROM k) AS b, (SELECT count(*) FROM l) AS c, (SELECT count(DISTINCT {_norm('text_ory')}) FROM l) AS d)
            SELECT 0 AS step, 'gates' AS stage, a AS rows_in, b AS rows_out, a - b AS dropped, true AS chained FROM n UNION ALL SELECT 1, 'bands', b, c, b - c, true FROM n UNION ALL SELECT 2, 'duplicates', c, d, c - d, true FROM n""",
        "a30_gap": f"""WITH {PREDICTED}, o AS (SELECT * FROM predictions WHERE NOT gold = 1 OR {_unit('example_id', 'native')} < 0.05::DOUBLE),
            b AS (SELECT {MACRO} AS b1, {R1} AS tpr, {_div('fp', 'fp + tn')} AS fpr FROM ({_cells('predictions')})), m AS (SELECT {MACRO} AS m1, {_div('tp + fn', 'tn + fp + fn + tp')} AS prev FROM ({_cells('o')})),
            e AS (SELECT *, {_expected('prev', 'tpr', 'fpr')} AS x FROM b, m)
            SELECT {_r('b1')} AS benchmark_f1, {_r('m1')} AS native_f1, {_r('x')} AS expected_f1, {_r('b1 - m1')} AS total_gap, {_r('b1 - x')} AS prevalence_gap, {_r('x - m1')} AS behaviour_gap FROM e""",
        "a31_constant_features": f"{features}, d AS (SELECT " + ", ".join(f"coalesce(stddev_pop({n}), 0) AS {n}" for n in FEATURES) + " FROM f) " + " UNION ALL ".join(f"SELECT '{n}' AS name, {_r(n, 4)} AS deviation, {n} = 0 AS constant FROM d" for n in FEATURES),
        "w1_largest_remainder": f"WITH c AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1) SELECT source, n, quota FROM {_remainder('c', 'source', '1000')}",
        "w3_downsample": f"WITH d AS (SELECT doc_id, source FROM documents WHERE source IS NOT NULL), q AS (SELECT source, ceil(count(*) / 3)::BIGINT AS quota FROM d GROUP BY 1) SELECT source, doc_id FROM {_draw('d', 'source', 's.doc_id', 'q')}",
        "w4_stratified_sample": f"WITH d AS (SELECT doc_id, source FROM documents WHERE source IS NOT NULL), c AS (SELECT source, count(*) AS n FROM d GROUP BY 1), q AS (SELECT source, least(quota, n) AS quota FROM {_remainder('c', 'source', '300')}) SELECT source, doc_id FROM {_draw('d', 'source', 's.doc_id', 'q')}",
        "w5_agreement_sample": f"WITH {RELEASE}, " + ", ".join(f"d{y} AS (SELECT example_id, label, source_config FROM rel WHERE label = {y} AND source_config IS NOT NULL), c{y} AS (SELECT source_config, count(*) AS n FROM d{y} GROUP BY 1), q{y} AS (SELECT source_config, least(quota, n) AS quota FROM {_remainder(f'c{y}', 'source_config', f'(SELECT least(100, count(*)) FROM d{y})')})" for y in (1, 0)) + " " + " UNION ALL ".join(f"SELECT example_id, label, source_config FROM {_draw(f'd{y}', 'source_config', 's.example_id', f'q{y}', f'42:{y}')}" for y in (1, 0)),
        "w6_representatives": f"WITH {GROUPED}, k AS (SELECT * FROM grouped WHERE label IS NOT NULL), {_representatives('k', 'g')} SELECT * FROM reps",
        "w7_review_sample": f"WITH d AS (SELECT DISTINCT example_id, reason FROM rejects WHERE example_id IS NOT NULL AND reason IS NOT NULL), q AS (SELECT DISTINCT reason, 5 AS quota FROM d) SELECT reason, example_id FROM {_draw('d', 'reason', 's.example_id', 'q')}",
        "w8_balance": f"WITH {BALANCE_QUOTA}, q AS {_remainder('oc', 'source_config', '(SELECT count(*) FROM hate)')} SELECT example_id, label, source_config FROM hate UNION ALL SELECT example_id, label, source_config FROM {_draw('other', 'source_config', 's.example_id', 'q')}",
        "w8_balance_match_minority": match,
        "o4_first_rows": "SELECT id, tier, text FROM canary_items ORDER BY id LIMIT 13",
        "o5_ranked_shares": f"WITH {RELEASE}, c AS (SELECT label, source_config, count(*) AS n FROM rel WHERE source_config IS NOT NULL AND label IS NOT NULL GROUP BY ALL), s AS (SELECT *, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY label) AS p FROM c) SELECT label, source_config, n, {_r('p')} AS pct, row_number() OVER (PARTITION BY label ORDER BY n DESC, source_config) = 1 AS top, p >= 95 AS alarm, row_number() OVER (PARTITION BY label ORDER BY n DESC, source_config)::INT AS place FROM s",
        "w9_sample": "SELECT doc_id FROM documents ORDER BY sha256('42::' || doc_id), doc_id LIMIT 250",
        "m4_token_lengths": "SELECT example_id, length(text_eng)::INT AS n_tokens FROM pairs WHERE text_eng IS NOT NULL",
        "m5_tiers": f"""WITH {SUITE}, o AS (SELECT coalesce(avg(score) FILTER (tier = 'clear_hate') - avg(score) FILTER (tier = 'clear_benign') > 0.5 AND min(score) FILTER (tier = 'clear_hate') > max(score) FILTER (tier = 'clear_benign'), false) AS ok FROM items),
            p AS (SELECT coalesce(bool_and(passed), false) AS ok FROM (SELECT CASE tier WHEN 'clear_hate' THEN min(score) >= 0.7::DOUBLE WHEN 'clear_benign' THEN max(score) <= 0.3::DOUBLE WHEN 'hard_negative' THEN max(score) <= 0.2::DOUBLE END AS passed FROM items WHERE NOT coalesce(documented_failure, false) GROUP BY tier))
            SELECT 0 AS step, 'probe' AS name, true AS passed, true AS reached UNION ALL SELECT 1, 'orientation', ok, true FROM o UNION ALL SELECT 2, 'pinned', CASE WHEN o.ok THEN p.ok END, o.ok FROM o, p""",
        "o2_largest_groups": f"WITH {GROUPED}, t AS (SELECT g, count(*) AS cluster_size FROM grouped GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 10), i AS (SELECT DISTINCT g, cluster_size, example_id FROM t JOIN grouped USING (g)) SELECT g, cluster_size, array_to_string(list_sort(list(example_id))[1:3], ',') AS ids FROM i GROUP BY ALL",
        "o3_confident_errors": f"WITH {PREDICTED} SELECT example_id, CASE WHEN pred = 1 THEN 'FP' ELSE 'FN' END AS kind, substr(text_eng, 1, 400) AS excerpt FROM predictions WHERE NOT correct ORDER BY greatest(prob_hate, 1 - prob_hate) DESC, example_id LIMIT 25",
        "d1_exact_survivors": f"WITH {RECORDS} SELECT min(example_id) AS example_id FROM records WHERE text_eng IS NOT NULL GROUP BY {_norm('text_eng')}",
        "d4_components_of_links": f"""WITH RECURSIVE {RECORDS}, n AS (SELECT example_id, {_norm('text_ory')} AS o, {_norm('text_eng')} AS e FROM records),
            l AS (SELECT DISTINCT n.example_id AS a, f.b FROM n JOIN (SELECT o, min(example_id) AS b FROM n GROUP BY 1) f ON n.o = f.o UNION SELECT DISTINCT n.example_id, f.b FROM n JOIN (SELECT e, min(example_id) AS b FROM n GROUP BY 1) f ON n.e = f.e),
            u AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT DISTINCT example_id AS x, example_id AS y FROM n UNION SELECT r.x, u.b FROM r JOIN u ON r.y = u.a)
            SELECT x AS example_id, min(y) AS root FROM r GROUP BY 1""",
        "m2_scored_texts": "SELECT example_id, round((length(regexp_replace(text_eng, '[^A-Z]', '', 'g'))::DOUBLE / greatest(length(text_eng), 1))::FLOAT::DOUBLE, 5) AS score FROM pairs WHERE text_eng IS NOT NULL",
        "n1_text_scores": " UNION ALL ".join(f"SELECT '{c}' AS name, {_r(f'100 * coalesce(avg(CASE WHEN length({c}) > 0 THEN {_count(c, ODIA)}::DOUBLE / length({c}) END), 0) + least(coalesce(avg(length({c})), 0), 200) / 200', 4)} AS score FROM pairs" for c in ("example_id", "doc_id", "source_config", "text_eng", "text_ory")),
        "slice_three_way": f"""WITH {SCORED}, {_gates(False, 'scored')}, k AS (SELECT *, sha256({_norm('text_ory')}) AS dedup_group FROM gated WHERE reason IS NULL AND label IS NOT NULL),
            {_representatives('k', 'dedup_group')} SELECT {_split('dedup_group')} AS part, label, source_config, count(*) AS n, sum(cluster_size)::BIGINT AS rows FROM reps GROUP BY ALL""",
    }
