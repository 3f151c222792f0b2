"""The two worked domains, sales orders and taxi-style trips, end to end."""
