from orrery.streaming.landing import land_new_files
from orrery.streaming.users import UserMaintenance, maintain_users

__all__ = ["UserMaintenance", "land_new_files", "maintain_users"]
