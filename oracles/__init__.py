"""Independent DuckDB statements for the registered queries."""


def all_oracles() -> dict[str, str]:
    from oracles import families, model, tables

    out = {}
    for module in (families, tables, model):
        out.update(module.oracles())
    return out
