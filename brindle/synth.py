"""A seeded inbox of claim files with planted defects, and the key that says what each run should find.

Files of successive weeks are written as a supplier would send them. Every defect is recorded in the
key with its file, row and the rule that has to catch it, so tests check that all are caught and
nothing else is.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field
from datetime import date, timedelta
from pathlib import Path

HEADER = "claim_id,member_mrn,fill_date,drug_name,days_supply,claim_status"
# Each defect's rule.
DEFECTS = {"lost_zeros": "C-001", "no_patient": "C-002", "bad_date": "C-003", "half_day": "C-004", "odd_status": "C-005", "odd_drug": "C-006", "future": "C-007", "unknown_patient": "C-008", "conflict": "C-009", "late": "C-010"}


@dataclass
class Inbox:
    """What was written: patients known, rows in files, and planted (file, row, rule)."""

    patients: list[str]
    files: dict[str, int] = field(default_factory=dict)
    planted: set[tuple[str, int, str]] = field(default_factory=set)
    good: int = 0


def write(folder: str | Path, weeks: int = 3, rows: int = 200, seed: int = 11, start: date = date(1998, 3, 6), defect_share: float = 0.12) -> Inbox:
    """Write ``weeks`` files; the same seed writes the same bytes."""
    rng = random.Random(seed)
    out = Inbox([f"{i:08d}" for i in range(1, 400)])
    claim = 1000
    for week in range(weeks):
        day = start + timedelta(7 * week)
        name = f"claims_{day:%Y%m%d}.csv"
        lines, n = [HEADER], 0
        while n < rows:
            n += 1
            claim += 1
            mrn, drug, days = rng.choice(out.patients), f"brand#{rng.randrange(1, 26)}", str(rng.choice((7, 30, 90)))
            filled, status = day - timedelta(rng.randrange(1, 60)), "P"
            kind = rng.choice([*DEFECTS]) if rng.random() < defect_share else None
            said = [str(claim), mrn, filled.isoformat(), drug, days, status]
            if kind == "lost_zeros":
                said[1] = str(int(mrn))
            elif kind == "no_patient":
                said[1] = " "
            elif kind == "bad_date":
                said[2] = "1998-02-31"
            elif kind == "half_day":
                said[4] = "7.5"
            elif kind == "odd_status":
                said[5] = "?"
            elif kind == "odd_drug":
                said[3] = "other"
            elif kind == "future":
                said[2] = (day + timedelta(3)).isoformat()
            elif kind == "unknown_patient":
                said[1] = "99999999"
            elif kind == "late":
                said[2] = (date(1997, 12, 1) + timedelta(rng.randrange(28))).isoformat()
            lines.append(",".join(said))
            if kind:
                out.planted.add((name, n, DEFECTS[kind]))
            if kind == "conflict" and n < rows:
                n += 1
                said[4] = "1" + said[4]
                lines.append(",".join(said))
                out.planted.add((name, n, DEFECTS[kind]))
            elif kind in (None, "lost_zeros", "late") or kind == "conflict":
                out.good += kind != "conflict"
            if kind == "conflict" and (name, n - 1, DEFECTS[kind]) not in out.planted:  # no room for its twin
                out.planted.discard((name, n, DEFECTS[kind]))
                out.good += 1
        out.files[name] = n
        at = Path(folder) / day.isoformat()
        at.mkdir(parents=True, exist_ok=True)
        (at / name).write_text("\r\n".join(lines) + "\r\n", encoding="utf-8-sig")
    return out
