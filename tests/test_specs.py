import pytest

from tarnish import TableSpec, get_config, list_configs, list_configs_by_domain, spec_from_columns, spec_from_config
from tarnish.plans.batch import training_configs
from tarnish.plans.cleaning import cleaning_plan
from tarnish.plans.injection import DIFFICULTY, STRATEGIES, InjectionConfig, required_operations
from tarnish.sources.builtin import DOMAINS, DatasetConfig, spec_for_domain
from tarnish.sources.files import format_list
from tarnish.sources.spec import CategoricalColumn, DatetimeColumn, NumericColumn


@pytest.mark.parametrize("domain", DOMAINS)
def test_specs_survive_a_dict_round_trip(domain):
    spec = spec_for_domain(domain, 77)
    assert TableSpec.from_dict(spec.to_dict()) == spec
    assert spec.num_rows == 77


def test_unknown_domain_is_an_error():
    with pytest.raises(ValueError, match="supported"):
        spec_for_domain("weather")


@pytest.mark.parametrize(
    "build",
    [
        lambda: NumericColumn("x", decimals=11),
        lambda: NumericColumn("x", distribution="cauchy"),
        lambda: NumericColumn(""),
        lambda: CategoricalColumn("x", []),
        lambda: CategoricalColumn("x", ["a", "b"], [1.0]),
        lambda: CategoricalColumn("x", ["a", "b"], [0.5, 0.4]),
        lambda: DatetimeColumn("x", "2024-01-02", "2024-01-01"),
        lambda: TableSpec("t", []),
        lambda: TableSpec("t", [NumericColumn("x"), NumericColumn("x")]),
        lambda: TableSpec("t", [NumericColumn("x")], num_rows=0),
        lambda: spec_from_columns("t", "d", [{"name": "x", "type": "blob"}]),
    ],
)
def test_bad_specs_are_rejected(build):
    with pytest.raises(ValueError):
        build()


def test_lookup_by_name_and_type():
    spec = spec_for_domain("ecommerce")
    assert spec.column("quantity").distribution == "poisson"
    assert spec.column("nothing") is None
    assert [c.name for c in spec.columns_of_type("datetime")] == ["order_date"]
    assert len(spec.columns_of_type("categorical")) == 5


def test_spec_from_short_dicts():
    spec = spec_from_columns(
        "staff",
        "hr",
        [
            {"name": "salary", "type": "numeric_float", "min": 40000, "max": 200000, "mean": 75000, "std": 25000},
            {"name": "team", "type": "categorical", "values": ["a", "b"], "frequencies": [0.7, 0.3]},
            {"name": "hired", "type": "datetime", "start_date": "2015-01-01"},
        ],
        300,
    )
    assert spec.column("salary").min_value == 40000
    assert spec.num_rows == 300


def test_spec_from_loose_config_fills_defaults():
    spec = spec_from_config(
        {
            "columns": [
                {"name": "a", "type": "numeric_int", "distribution": "zipf"},
                {"name": "b", "type": "Numeric_Float"},
                {"name": "c", "type": "categorical", "categories": ["x"]},
                {"name": "d", "type": "datetime"},
                {"name": "e", "type": "picture"},
            ]
        }
    )
    a, b = spec.column("a"), spec.column("b")
    assert (a.distribution, a.min_value, a.max_value) == ("uniform", 1, 10000)
    assert (b.integer, b.max_value) == (False, 1000.0)
    assert spec.column("d").start_date == "2023-01-01"
    assert spec.column("e") is None


def test_presets():
    assert len(list_configs()) == 13
    assert get_config("ecommerce_text_only").strategies == ("text_whitespace", "text_case", "text_special_chars")
    assert get_config("finance_large_hard").num_rows == 5000
    assert len(list_configs_by_domain("ecommerce")) == 7
    with pytest.raises(KeyError, match="available"):
        get_config("nope")
    config = get_config("ecommerce_numeric_only")
    assert DatasetConfig.from_dict(config.to_dict()) == config


@pytest.mark.parametrize("level", DIFFICULTY)
def test_difficulty_draws_as_many_strategies_as_it_says(level):
    low, high = DIFFICULTY[level]
    sizes = set()
    for seed in range(60):
        config = InjectionConfig.from_difficulty(level, seed)
        assert len(set(config.strategies)) == len(config.strategies)
        assert set(config.strategies) <= set(STRATEGIES)
        sizes.add(len(config.strategies))
    assert sizes == set(range(low, high + 1))
    assert InjectionConfig.from_difficulty(level, 5) == InjectionConfig.from_difficulty(level, 5)


def test_unknown_difficulty_is_an_error():
    with pytest.raises(ValueError):
        InjectionConfig.from_difficulty("extreme")


def test_copies_are_made_last_unless_told_otherwise():
    config = InjectionConfig.custom(["duplicates", "text_case"])
    assert config.order == ["text_case", "duplicates"]
    assert config.with_options(duplicates_last=False).order == ["duplicates", "text_case"]


def test_cleaning_plan_order_and_merged_text_steps():
    plan = cleaning_plan(["duplicates", "text_special_chars", "outliers", "text_case", "type_corruption", "missing_values"])
    assert [p.operation for p in plan] == [
        "clean_text_columns",
        "convert_data_types",
        "handle_missing_values",
        "remove_outliers",
        "remove_duplicates",
    ]
    assert list(plan[0].operator.operations) == ["lower", "remove_special"]
    assert plan[0].to_dict()["operations"] == ["lower", "remove_special"]
    assert required_operations(["text_case", "text_whitespace", "outliers"]) == ["clean_text_columns", "remove_outliers"]


def test_training_configs_count_up_seeds():
    configs = training_configs("finance", 2, 1, 1, 50, 7)
    assert [c.name for c in configs] == ["finance_easy_1", "finance_easy_2", "finance_medium_1", "finance_hard_1"]
    assert [c.seed for c in configs] == [7, 8, 9, 10]


def test_formats():
    assert format_list("all") == ["csv", "parquet", "json"]
    assert format_list(["json", "all"]) == ["json", "csv", "parquet"]
    with pytest.raises(ValueError):
        format_list("xlsx")
