"""brindle.plans"""
