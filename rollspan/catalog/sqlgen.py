"""Oracle text for windowed families, built the other way round: each window is aggregated
straight from the rows it covers and left-joined to the widest one, with no weekly
snapshots in between."""

from __future__ import annotations

from datetime import timedelta

from rollspan.catalog.registry import I, R, role_sql
from rollspan.functions.calendar import as_date, ymd

WINDOWS = (1, 4, 12, 24)
WK = "dayofweek({d}) IN (0, 6)"


def since(snapshot: str, weeks: int) -> str:
    return ymd(as_date(snapshot) - timedelta(days=7 * weeks))


def filtered(cond: str | None) -> str:
    return f" FILTER (WHERE {cond})" if cond else ""


def div(a: str, b: str) -> str:
    return f'(CAST("{a}" AS DOUBLE) / nullif("{b}", 0))'


def part_conditions(parts: str = "wk wd dt nt") -> dict[str, str]:
    full = {"wk": "is_wk", "wd": "NOT is_wk", "dt": "slot = 'dt'", "nt": "slot = 'nt'"}
    return {p: full[p] for p in parts.split()}


def both(a: str | None, b: str | None) -> str | None:
    return f"({a}) AND ({b})" if a and b else a or b


class Windowed:
    """Collects aggregates (int or double), then ratios, then trends."""

    def __init__(self, role: str, snapshot: str, keys=("msisdn",), windows=WINDOWS, derive: str = "", unit: str = "w",
                 source: str | None = None, day: str = "s3_file_date"):
        self.snapshot, self.keys, self.windows, self.unit, self.day = snapshot, keys, windows, unit, day
        self.rows = source or f"SELECT *{', ' + derive if derive else ''} FROM ({role_sql(role)})"
        self.ints: dict[str, str] = {}
        self.doubles: dict[str, str] = {}
        self.derived: list[dict[str, str]] = []
        self.trends: list[tuple[list[str], int]] = []
        self.ctes: list[tuple[str, str]] = []

    def count(self, stem, cond=None, zero=False):
        # a count without hits is NULL unless the family counts with ELSE 0
        n = f"count(*){filtered(cond)}"
        self.ints[stem] = n if zero or cond is None else f"nullif({n}, 0)"

    def agg(self, stem, op, value, cond=None, integer=False):
        (self.ints if integer else self.doubles)[stem] = f"{op}({value}){filtered(cond)}"

    def ratios(self, spec: dict[str, tuple[str, str]]):
        self.derived.append({s: ("ratio", a, b) for s, (a, b) in spec.items()})

    def exprs(self, spec: dict[str, str]):
        """stem -> expression with ``{w}`` for the window suffix and ``{n}`` for its length."""
        self.derived.append({s: ("expr", e) for s, e in spec.items()})

    def trend(self, stems, gap=1):
        self.trends.append((list(stems), gap))

    def sql(self, final_int=()) -> str:
        w = lambda n: f"l{n}{self.unit}"
        ctes = [("rows_", self.rows), *self.ctes]
        source = ctes[-1][0]
        keys = ", ".join(self.keys)
        stems = {**self.ints, **self.doubles}
        widest = max(self.windows)
        for n in self.windows:
            cols = ", ".join(f'{e} AS "{s}_{w(n)}"' for s, e in stems.items())
            ctes.append((f"win{n}", f"SELECT {keys}, {cols} FROM {source} WHERE {self.day} >= '{since(self.snapshot, n)}' "
                                    f"AND {self.day} < '{self.snapshot}' GROUP BY {keys}"))
        joins = " ".join(f"LEFT JOIN win{n} USING ({keys})" for n in self.windows if n != widest)
        ctes.append(("wide0", f"SELECT * FROM win{widest} {joins}"))
        names = [f"{s}_{w(n)}" for s in stems for n in self.windows]
        ints = {f"{s}_{w(n)}" for s in self.ints for n in self.windows}
        for i, layer in enumerate(self.derived):
            cols = []
            for s, spec in layer.items():
                for n in self.windows:
                    name = f"{s}_{w(n)}"
                    if spec[0] == "ratio":
                        e = div(f"{spec[1]}_{w(n)}", f"{spec[2]}_{w(n)}")
                    else:
                        e = spec[1].format(w=w(n), n=n)
                    cols.append(f'{e} AS "{name}"')
                    names.append(name)
                    if s in final_int:
                        ints.add(name)
            ctes.append((f"wide{i + 1}", f"SELECT *, {', '.join(cols)} FROM wide{i}"))
        last = f"wide{len(self.derived)}"
        out = [f'{k}' for k in self.keys]
        out += [I(f'"{n}"', n) if n in ints else R(f'"{n}"', n) for n in names]
        for stems_, gap in self.trends:
            for s in stems_:
                for i, x in enumerate(self.windows):
                    for y in self.windows[i + gap:]:
                        out.append(R(div(f"{s}_{w(x)}", f"{s}_{w(y)}"), f"{s}_{w(x)}_vs_{w(y)}"))
        with_ = ",\n".join(f"{n} AS ({q})" for n, q in ctes)
        return f"WITH {with_}\nSELECT {', '.join(out)} FROM {last}"


def per_day(stem: str) -> str:
    return f'CAST("{stem}_{{w}}" AS DOUBLE) / (7 * {{n}})'


def nullable_sum(stems: list[str]) -> str:
    total = " + ".join(f'coalesce("{s}_{{w}}", 0)' for s in stems)
    some = ", ".join(f'"{s}_{{w}}"' for s in stems)
    return f"CASE WHEN coalesce({some}) IS NOT NULL THEN {total} END"
