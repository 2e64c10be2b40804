"""Reusable relational operators: crosswalks, carriers, pre-aggregation."""
