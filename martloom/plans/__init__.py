"""Marts, insights and models built from the operators."""
