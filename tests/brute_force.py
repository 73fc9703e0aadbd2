"""The warehouse in plain Python over a few rows, as an independent model for tests."""

from __future__ import annotations

import datetime
import re
from collections import defaultdict

from tallyhouse.plans.dimensions import DIMENSIONS


def day_of(text):
    found = re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{4})", text or "")
    if not found:
        return None
    month, day, year = map(int, found.groups())
    try:
        return datetime.date(year, month, day)
    except ValueError:
        return None


def nulls_first(values):
    return [(v is not None, v if v is not None else 0) for v in values]


def dimension(rows, spec):
    """{business key: (surrogate, attributes)}"""
    kept = {}
    attributes = [c for c in spec.sources if c not in spec.keys]

    def value(row, column):
        found = row.get(spec.sources[column])
        return day_of(found) if column.endswith("_date") else found

    for row in rows:
        key = tuple(value(row, c) for c in spec.keys)
        mine = tuple(value(row, c) for c in attributes)
        if key not in kept or nulls_first(mine) < nulls_first(kept[key]):
            kept[key] = mine
    return {
        key: (number, dict(zip(attributes, kept[key])))
        for number, key in enumerate(sorted(kept, key=nulls_first), 1)
    }


def star(rows):
    dims = {name: dimension(rows, spec) for name, spec in DIMENSIONS.items()}
    fact = []
    for row in rows:
        keys = {}
        for name, spec in DIMENSIONS.items():
            key = tuple(row.get(spec.sources[c]) for c in spec.keys)
            keys[spec.fact_key] = None if None in key else dims[name][key][0]
        day = day_of(row.get("sale_date"))
        keys["date_key"] = day and day.year * 10000 + day.month * 100 + day.day
        fact.append((
            keys["customer_key"], keys["seller_key"], keys["product_key"], keys["store_key"],
            keys["supplier_key"], keys["date_key"], row.get("sale_quantity"),
            row.get("sale_total_price"), row.get("product_price"),
        ))
    return dims, fact


def total(values):
    """Exact over two decimals; null without any value."""
    known = [round(v * 100) for v in values if v is not None]
    return sum(known) / 100 if known else None


def mean(values):
    known = [v for v in values if v is not None]
    return total(values) / len(known) if known else None


def grouped(fact, column):
    groups = defaultdict(list)
    for sale in fact:
        if sale[column] is not None:
            groups[sale[column]].append(sale)
    return groups


def rank(value, values):
    low = float("-inf")
    order = [low if v is None else v for v in values]
    return 1 + sum(v > (low if value is None else value) for v in order)


def marts(dims, fact):
    """The six marts as lists of tuples, in the column order of their contracts."""
    out = {}
    by_key = {name: {number: (key, attrs) for key, (number, attrs) in dims[name].items()}
              for name in dims}

    found = []
    for key, sales in grouped(fact, 2).items():
        (product,), attrs = by_key["dim_product"][key]
        quantity = [s[6] for s in sales if s[6] is not None]
        found.append((product, attrs["name"] or "Unknown", attrs["category"] or "Unknown",
                      sum(quantity) if quantity else None, total(s[7] for s in sales),
                      attrs["rating"], attrs["reviews"]))
    column = lambda i: [f[i] for f in found]
    out["mart_product_sales"] = [
        (*f[:3], f[3] or 0, f[4] or 0.0, f[5] or 0.0, f[6] or 0,
         rank(f[3], column(3)), rank(f[4], column(4))) for f in found
    ]
    out["mart_product_quality"] = [
        (*f[:3], f[5] or 0.0, f[6] or 0, f[3] or 0, f[4] or 0.0,
         rank(f[5], column(5)), rank(f[6], column(6)), rank(f[3], column(3))) for f in found
    ]

    rows = []
    for key, sales in grouped(fact, 0).items():
        (customer,), attrs = by_key["dim_customer"][key]
        name = " ".join(n for n in (attrs["first_name"], attrs["last_name"]) if n is not None)
        prices = [s[7] for s in sales]
        rows.append((customer, name, attrs["country"] or "Unknown", total(prices), len(sales),
                     mean(prices)))
    out["mart_customer_sales"] = [
        (*r[:3], r[3] or 0.0, r[4], r[5] or 0.0, rank(r[3], [x[3] for x in rows])) for r in rows
    ]

    rows = []
    for key, sales in grouped(fact, 3).items():
        prices = [s[7] for s in sales]
        rows.append((key, *by_key["dim_store"][key][0], total(prices), len(sales), mean(prices)))
    out["mart_store_sales"] = [
        (*r[:4], r[4] or 0.0, r[5], r[6] or 0.0, rank(r[4], [x[4] for x in rows])) for r in rows
    ]

    rows = []
    for key, sales in grouped(fact, 4).items():
        name, _, country = by_key["dim_supplier"][key][0]
        rows.append((key, name, country, total(s[7] for s in sales), mean([s[8] for s in sales]),
                     len(sales)))
    out["mart_supplier_sales"] = [
        (*r[:3], r[3] or 0.0, r[4] or 0.0, r[5], rank(r[3], [x[3] for x in rows])) for r in rows
    ]

    rows = []
    months = defaultdict(list)
    for day, sales in grouped(fact, 5).items():
        months[day // 100].extend(sales)
    for month, sales in months.items():
        prices = [s[7] for s in sales]
        name = datetime.date(month // 100, month % 100, 1).strftime("%B")
        rows.append((month // 100, month % 100, name, total(prices) or 0.0, len(sales),
                     mean(prices) or 0.0))
    out["mart_time_sales"] = rows
    return out
