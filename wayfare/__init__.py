"""Ride, connected-car and mail analytics as plain DataFrame and Column functions."""
