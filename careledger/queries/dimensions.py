"""Category and attribute dimensions."""

from __future__ import annotations

from careledger.operators.dimensions import build_dimension
from careledger.queries.base import AS_OF, query, view

_COLUMNS = {
    "category": {
        "economy_gro_e": "ECONOMY [größe]", "large_gro_e": "LARGE [größe]", "medium_gro_e": "MEDIUM [größe]",
        "economy_gro_e_2": "economy (Größe)", "large_gro_e_2": "large (Größe)",
        "medium_gro_e_2": "medium (Größe)",
    },
    "attribute": {
        "promo_gro_e": "promo (Größe)", "small_gro_e": "small (Größe)", "standard_gro_e": "standard (Größe)",
    },
}


def _oracle(combo_type: str) -> str:
    # The view names both types after their part type in lower case.
    names = ", ".join(f"'{name}' AS {column}" for column, name in _COLUMNS[combo_type].items())
    return f"""
    WITH categories AS (SELECT id AS category_id, name AS category FROM {{cat}} WHERE combo_type = '{combo_type}'),
    placed AS (SELECT categoryoption_id, category FROM {{cat_opt}} JOIN categories USING (category_id)),
    named AS (SELECT id AS categoryoption_id, name AS option FROM {{opt}} WHERE combo_type = '{combo_type}'),
    filled AS (
        SELECT categoryoptioncombo_id, category, option
        FROM {{coc_opt}} JOIN named USING (categoryoption_id) JOIN placed USING (categoryoption_id)
    ), wide AS (
        FROM (PIVOT filled ON category IN ({names}) USING max(option) GROUP BY categoryoptioncombo_id)
    )
    SELECT wide.*, 'hmis' AS datasource_id, categorycombo_id, code AS categoryoptioncombo_code,
        name AS categoryoptioncombo_name
    FROM wide JOIN {{brand_sizes}} combos ON combos.id = categoryoptioncombo_id"""


def _built(spark, sf_dir, combo_type):
    inputs = [view(spark, sf_dir, v) for v in ("brand_sizes", "coc_opt", "opt", "cat_opt", "cat")]
    return build_dimension(*inputs, combo_type, "hmis", AS_OF)


@query("category_dimension", _oracle("category"))
def _category(spark, sf_dir):
    return _built(spark, sf_dir, "category")[0].drop("_builtat")


@query("attribute_dimension", _oracle("attribute"))
def _attribute(spark, sf_dir):
    return _built(spark, sf_dir, "attribute")[0].drop("_builtat")


@query("name_map", """
    WITH named AS (SELECT DISTINCT name FROM {cat} WHERE combo_type = 'category' AND name IS NOT NULL),
    bases AS (SELECT name, regexp_replace(regexp_replace(lower(strip_accents(name)), '[^a-z0-9]+', '_', 'g'),
        '^_|_$', '', 'g') AS base FROM named),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY name) AS n FROM bases)
    SELECT name AS original_name, CASE WHEN n = 1 THEN base ELSE concat(base, '_', n) END AS safe_name,
        'hmis' AS datasource_id FROM ranked""")
def _name_map(spark, sf_dir):
    return _built(spark, sf_dir, "category")[1].drop("_builtat")
