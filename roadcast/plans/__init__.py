"""roadcast.plans"""
