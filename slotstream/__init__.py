"""Appointment change data on Spark: decode, warehouse, schedules, bookings, notifications."""
