"""Column roles: the only place where column names, label fixes and label orders live.

Operators take a :class:`Roles` (or plain column names), so another table is profiled and prepared by describing
its columns here rather than by editing operators.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass, field


@dataclass(frozen=True)
class Roles:
    """Names the columns of one flat sales table and the fixed values that go with them."""

    item: str
    item_type: str
    fat_content: str
    weight: str
    visibility: str
    price: str
    outlet: str
    outlet_type: str
    outlet_size: str
    outlet_location: str
    opened_year: str
    target: str
    label_fixes: Mapping[str, Mapping[str, str]]
    label_order: Mapping[str, tuple[str, ...]]
    price_labels: tuple[str, ...]
    reference_year: int
    smoothing: float
    # Names given to engineered columns.
    age: str = "Outlet_Age"
    price_band: str = "MRP_Category"
    price_per_weight: str = "MRP_per_Weight"
    visibility_per_price: str = "Visibility_MRP_Ratio"
    price_times_age: str = "MRP_x_Outlet_Age"
    outlet_encoding: str = "Outlet_Target_Encoded"
    passthrough: tuple[str, ...] = field(default=())

    def as_dict(self) -> dict:
        """As values that JSON can hold; :meth:`of_dict` reads them back."""
        return asdict(self)

    @classmethod
    def of_dict(cls, values: Mapping) -> Roles:
        tuples = {name: tuple(values[name]) for name in ("price_labels", "passthrough")}
        order = {column: tuple(labels) for column, labels in values["label_order"].items()}
        return cls(**{**values, **tuples, "label_order": order})

    @property
    def ids(self) -> list[str]:
        return [self.item, self.outlet]

    @property
    def numeric(self) -> list[str]:
        """Numeric columns in report order, the target last."""
        return [self.weight, self.visibility, self.price, self.opened_year, self.target]

    @property
    def numeric_features(self) -> list[str]:
        return [c for c in self.numeric if c != self.target]

    @property
    def categorical(self) -> list[str]:
        """All label columns, the item id included."""
        return [self.item, *self.category_features]

    @property
    def category_features(self) -> list[str]:
        """Label columns that get value counts and category statistics (no item id)."""
        return [self.fat_content, self.item_type, self.outlet, self.outlet_size, self.outlet_location, self.outlet_type]

    @property
    def ordinal(self) -> list[str]:
        return list(self.label_order)

    @property
    def nominal(self) -> list[str]:
        """Columns that become one-hot blocks, in output order."""
        return [self.item_type, self.outlet_type, self.price_band]

    @property
    def interactions(self) -> list[tuple[str, str]]:
        """Pairs of label columns shown as pivots of the mean target."""
        return [
            (self.item_type, self.outlet_type),
            (self.fat_content, self.outlet_size),
            (self.outlet_location, self.outlet_type),
            (self.item_type, self.outlet_location),
        ]


# Column names, label corrections, label orders and band names of the published retail data set.
RETAIL = Roles(
    item="Item_Identifier",
    item_type="Item_Type",
    fat_content="Item_Fat_Content",
    weight="Item_Weight",
    visibility="Item_Visibility",
    price="Item_MRP",
    outlet="Outlet_Identifier",
    outlet_type="Outlet_Type",
    outlet_size="Outlet_Size",
    outlet_location="Outlet_Location_Type",
    opened_year="Outlet_Establishment_Year",
    target="Item_Outlet_Sales",
    label_fixes={
        "Item_Fat_Content": {"LF": "Low Fat", "low fat": "Low Fat", "reg": "Regular"},
        "Item_Type": {
            "Fruits & Vegetables": "Fruits and Vegetables",
            "Health & Hygiene": "Health and Hygiene",
        },
        "Outlet_Location_Type": {
            "Tier1": "Tier 1",
            "Tier2": "Tier 2",
            "Tier3": "Tier 3",
            "tier 1": "Tier 1",
            "tier 2": "Tier 2",
            "tier 3": "Tier 3",
        },
        "Outlet_Size": {
            "high": "High",
            "medium": "Medium",
            "small": "Small",
            "SMALL": "Small",
            "MEDIUM": "Medium",
            "HIGH": "High",
        },
        "Outlet_Type": {
            "Grocery": "Grocery Store",
            "Supermarket Type 1": "Supermarket Type1",
            "Supermarket Type 2": "Supermarket Type2",
            "Supermarket Type 3": "Supermarket Type3",
        },
    },
    # Codes are positions, counted from 0.
    label_order={
        "Item_Fat_Content": ("Low Fat", "Regular"),
        "Outlet_Location_Type": ("Tier 3", "Tier 2", "Tier 1"),
        "Outlet_Size": ("Small", "Medium", "High"),
    },
    price_labels=("Low", "Low-Med", "Medium", "Med-High", "High"),
    reference_year=2024,
    smoothing=10.0,
)
