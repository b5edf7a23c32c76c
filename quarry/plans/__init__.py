"""Query plans: compositions of operators over the fixture views, plus the registry."""
