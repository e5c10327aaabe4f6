"""ambermill.plans"""
