"""The 54 business questions by name."""

from __future__ import annotations

from shelfwise.plans import executive, inventory, network, sales, store_product, supplier

THEMES = (inventory, sales, supplier, network, store_product, executive)
QUESTIONS = {
    f"q{n:02d}": getattr(theme, f"q{n:02d}")
    for n in range(1, 55)
    for theme in THEMES
    if hasattr(theme, f"q{n:02d}")
}
