"""Query plans: reports (F, G), document questions (H), rollup questions (I)."""
