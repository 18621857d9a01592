"""Typed configuration: column contracts, feature groups, gates, search space.

Nothing in the operators hard-codes a column name; everything comes from
these objects, which can be built from a plain dict (e.g. a parsed YAML file).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class ColumnContract:
    column: str
    dtype: str = "str"
    mostly: float = 1.0
    min: float | None = None
    max: float | None = None
    allowed_values: tuple | None = None
    sentinel_values: tuple = ()

    @staticmethod
    def from_dict(column: str, d: dict[str, Any]) -> "ColumnContract":
        allowed = d.get("allowed_values")
        return ColumnContract(
            column=column,
            dtype=d.get("dtype", "str"),
            mostly=float(d.get("mostly", 1.0)),
            min=d.get("min"),
            max=d.get("max"),
            allowed_values=tuple(allowed) if allowed is not None else None,
            sentinel_values=tuple(d.get("sentinel_values") or ()),
        )


def contracts_from_dict(d: dict[str, dict]) -> list[ColumnContract]:
    return [ColumnContract.from_dict(k, v) for k, v in d.items()]


# The crash-record contract of the original pipeline (28 columns).
_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
           "September", "October", "November", "December"]
_VEH_USE = ["Club or Church", "Commercial", "Farm", "In Pursuit or Emergency (in use)", "Military Vehicle",
            "Other", "Other Government, Non-Emergency", "Private", "Road Construction or Maintenance",
            "School or Education", "Uncoded & Errors", "Utility"]
CRASH_CONTRACT: dict[str, dict] = {
    "HOUR": {"dtype": "int", "min": 0, "max": 23, "sentinel_values": [99], "mostly": 0.996},
    "DAYOFWEEK": {"dtype": "str", "allowed_values": _DAYS, "mostly": 1.0},
    "MONTH": {"dtype": "str", "allowed_values": _MONTHS, "mostly": 1.0},
    "YEAR": {"dtype": "int", "min": 2008, "max": 2017, "mostly": 1.0},
    "WEATHER": {"dtype": "str", "allowed_values": [
        "Blowing Snow", "Clear", "Cloudy", "Fog", "Rain", "Severe Crosswind", "Sleet or Hail", "Smoke", "Snow",
        "Uncoded & Errors", "Unknown"], "mostly": 1.0},
    "SURFCOND": {"dtype": "str", "allowed_values": [
        "Debris", "Dry", "Icy", "Mud, Dirt, Gravel", "Oily", "Other", "Slush", "Snowy", "Uncoded & Errors",
        "Unknown", "Water", "Wet"], "mostly": 1.0},
    "LIGHTING": {"dtype": "str", "allowed_values": [
        "Dark, Lighted", "Dark, Unlighted", "Dawn", "Daylight", "Dusk", "Other", "Uncoded & Errors", "Unknown"],
        "mostly": 1.0},
    "SPEEDLIMIT": {"dtype": "int", "min": 0, "max": 98, "sentinel_values": [99], "mostly": 0.989},
    "RDNUMLANES": {"dtype": "int", "min": 0, "max": 6, "mostly": 1.0},
    "RDWIDTH": {"dtype": "float", "min": 0.0, "max": 80.0, "mostly": 1.0},
    "ROUTECLASS": {"dtype": "str", "allowed_values": [
        "Connector", "County Road or City Street or Not Known", "Interstate Business Loop or Spur",
        "Interstate Route", "M Route", "Not Located", "U.S. Business Route", "U.S. Route"], "mostly": 1.0},
    "TRUNKLINE": {"dtype": "str", "allowed_values": ["Non-Trunkline", "Trunkline"], "mostly": 1.0},
    "RDSUBTYPE": {"dtype": "int", "allowed_values": [0, 30, 31, 33, 34, 35, 36, 37, 38], "mostly": 1.0},
    "DRIVER1AGE": {"dtype": "int", "min": 0, "max": 100, "sentinel_values": [999], "mostly": 0.85},
    "DRIVER1SEX": {"dtype": "str", "allowed_values": ["F", "M", "U"], "mostly": 1.0},
    "DRIVER2AGE": {"dtype": "int", "min": 0, "max": 100, "sentinel_values": [999], "mostly": 0.65},
    "DRIVER2SEX": {"dtype": "str", "allowed_values": ["F", "M", "U"], "mostly": 1.0},
    "VEH1TYPE": {"dtype": "str", "allowed_values": [
        "Go-cart / Golf Cart", "Moped", "Motorcycle", "Motorhome", "Off-Road Vehicle, All-Terrain Vehicle",
        "Other Non-Commercial", "Passenger Car, SUV, Van", "Pickup Truck", "Truck / Bus (Commercial)",
        "Truck Under 10,000 lbs", "Uncoded & Errors"], "mostly": 1.0},
    "VEH1USE": {"dtype": "str", "allowed_values": _VEH_USE, "mostly": 1.0},
    "VEH2TYPE": {"dtype": "str", "allowed_values": [
        "Go-cart / Golf Cart", "Moped", "Motorcycle", "Motorhome", "Off-Road Vehicle, All-Terrain Vehicle",
        "Other Non-Commercial", "Passenger Car, SUV, Van", "Pickup Truck", "Snowmobile",
        "Truck / Bus (Commercial)", "Truck Under 10,000 lbs", "Uncoded & Errors"], "mostly": 1.0},
    "VEH2USE": {"dtype": "str", "allowed_values": _VEH_USE, "mostly": 1.0},
    "CRASHTYPE": {"dtype": "str", "allowed_values": [
        "Angle Driveway", "Angle Straight", "Angle Turn", "Animal", "Backing", "Bicycle", "Fixed Object",
        "Head-On Left-Turn Not Associated with Driveway", "Head-on", "Hit Train", "Misc. Multiple Vehicle",
        "Misc. Single Vehicle", "Other Driveway", "Other Object", "Overturn", "Parking", "Pedestrian",
        "Rear End Driveway", "Rear End Left Turn", "Rear End Right Turn", "Rear End Straight",
        "Side-Swipe Opposite", "Side-Swipe Same"], "mostly": 1.0},
    "TRAFCTLDEV": {"dtype": "str", "allowed_values": [
        "Signal", "Stop Sign", "Stop Sign with Flashing Beacon", "Uncoded & Errors", "Yield Sign"], "mostly": 0.4},
    "NONTRAFFIC": {"dtype": "str", "allowed_values": ["No"], "mostly": 1.0},
    "CRASHSEVER": {"dtype": "str", "allowed_values": ["Fatal", "Injury", "Property Damage Only"], "mostly": 1.0},
    "X": {"dtype": "float", "min": -85.76, "max": -85.56, "mostly": 1.0},
    "Y": {"dtype": "float", "min": 42.88, "max": 43.04, "mostly": 1.0},
    "NUMOFVEHIC": {"dtype": "int", "min": 1, "max": 12, "mostly": 1.0},
}

# Month and weekday ordinals (month 0..11, Monday = 0).
MONTH_NAMES = _MONTHS
WEEKDAY_NAMES = _DAYS
# Target names -> codes.
SEVERITY_CODES = {"Property Damage Only": 0, "Injury": 1, "Fatal": 2}

# Contract for the ``records`` stand-in view (same rule shapes on driver data).
RECORDS_CONTRACT: dict[str, dict] = {
    "hour": {"dtype": "int", "min": 0, "max": 23, "sentinel_values": [99], "mostly": 0.996},
    "weekday": {"dtype": "str", "allowed_values": _DAYS, "mostly": 1.0},
    "year": {"dtype": "int", "min": 1995, "max": 2000, "mostly": 1.0},
    "month_no": {"dtype": "int", "min": 1, "max": 12, "mostly": 1.0},
    "speed_limit": {"dtype": "int", "min": 0, "max": 98, "sentinel_values": [99], "mostly": 0.989},
    "driver_age": {"dtype": "int", "min": 0, "max": 100, "sentinel_values": [999], "mostly": 0.85},
    "weather": {"dtype": "str", "allowed_values": ["A", "N", "R"], "mostly": 1.0},
    "surface": {"dtype": "str", "allowed_values": ["F", "O"], "mostly": 1.0},
    "n_vehicles": {"dtype": "int", "min": 1, "max": 12, "mostly": 1.0},
    "x1": {"dtype": "float", "min": 0.0, "max": 120000.0, "mostly": 1.0},
    "severity": {"dtype": "str", "allowed_values": ["Fatal", "Injury", "Property Damage Only"], "mostly": 1.0},
}


@dataclass
class FeatureConfig:
    """Which columns are features and how each group is prepared."""

    numeric: list[str]
    categorical: list[str]
    cyclical: dict[str, float]
    target: str
    target_codes: dict[str, int]
    ordinal: dict[str, list] = field(default_factory=dict)
    sentinel_columns: list[str] = field(default_factory=list)
    sentinel_value: float | None = None
    forbidden: list[str] = field(default_factory=list)
    interaction_flags: bool = True
    key: str = "row_id"
    train_size: float = 0.6
    val_size: float = 0.2
    test_size: float = 0.2
    seed: int = 42

    @property
    def features(self) -> list[str]:
        return list(dict.fromkeys(self.numeric + self.categorical + list(self.cyclical) + list(self.ordinal)))


def records_feature_config() -> FeatureConfig:
    """Feature configuration of the ``records`` stand-in (mirrors the crash setup)."""
    return FeatureConfig(
        numeric=["year", "speed_limit", "driver_age", "x1", "x2", "x3"],
        categorical=["weather", "surface"],
        cyclical={"hour": 24.0, "month_no": 12.0, "weekday": 7.0},
        target="severity",
        target_codes=dict(SEVERITY_CODES),
        sentinel_columns=["driver_age"],
        sentinel_value=999,
        forbidden=["n_harmed"],
    )


@dataclass
class Gates:
    macro_f1: float = 0.30
    class_recall: float = 0.50
    strict: bool = True


@dataclass
class SearchSpace:
    """Mixed search space: (kind, low, high) or ("choice", values)."""

    params: dict[str, tuple] = field(default_factory=lambda: {
        "latent_dim": ("choice", (8, 16, 32, 64)),
        "target_ratio": ("choice", (0.05, 0.1, 0.15, 0.2)),
        "threshold": ("uniform", 0.02, 0.2),
        "focal_gamma": ("uniform", 0.5, 5.0),
        "prior_boost": ("uniform", 1.0, 5.0),
        "reg_param": ("loguniform", 1e-4, 1e-1),
    })
